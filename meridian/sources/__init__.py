"""Readers: driver tables, stored responses, bulk CSV, zipped spreadsheets, landed runs."""
