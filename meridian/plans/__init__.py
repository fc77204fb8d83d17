"""Plans: derived inputs, registered queries with their SQL oracles, load plans and models."""
