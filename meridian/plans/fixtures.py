"""Derived raw inputs built from the driver tables.

Each builder returns SQL text in the subset both Spark SQL and the oracle engine accept
(``CAST(.. AS STRING)``, ``lpad``, ``concat``, ``chr``, ``%``, ``CASE``), so the very same
text builds the input on both sides and only the operator under test differs.
"""

from __future__ import annotations

from meridian.operators.conform import HOSPITAL_COLUMNS


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _measure(key: str, salt: int, col: str) -> str:
    """A measure count as text in several spellings, with the sentinel every 7th row."""
    base = f"(({key} + {salt}) % 11)"
    return (
        f"CASE WHEN {key} % 7 = {salt % 7} THEN 'Not Available' "
        f"WHEN ({key} + {salt}) % 5 = 1 THEN concat(' ', {_text(base)}, ' ') "
        f"WHEN ({key} + {salt}) % 5 = 2 THEN concat({_text(base)}, '.0') "
        f"WHEN ({key} + {salt}) % 13 = 3 THEN '' "
        f"ELSE {_text(base)} END AS {col}"
    )


def _footnote(key: str, salt: int, col: str) -> str:
    return (
        f"CASE ({key} + {salt}) % 4 WHEN 0 THEN '' WHEN 1 THEN '   ' "
        f"WHEN 2 THEN concat(' ', {_text(salt)}, ' ') ELSE NULL END AS {col}"
    )


def raw_facilities(dirty: bool = False) -> str:
    """B1 (and B2 when ``dirty``): a hospital-shaped all-text raw table from supplier x nation."""
    k = "s.s_suppkey"
    facility = f"lpad({_text(k)}, 6, '0')"
    zip_code = f"lpad({_text(f'{k} % 100000')}, 5, '0')"
    rating = (
        f"CASE {k} % 8 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '4' "
        f"WHEN 4 THEN '5' WHEN 5 THEN 'Not Available' WHEN 6 THEN '4.6' ELSE '' END"
    )
    if dirty:
        facility = f"CASE WHEN {k} % 50 = 49 THEN lpad({_text(f'{k} - 1')}, 6, '0') ELSE {facility} END"
        zip_code = (
            f"CASE WHEN {k} % 17 = 0 THEN NULL "
            f"WHEN {k} % 23 = 0 THEN lpad({_text(f'{k} % 10000')}, 4, '0') "
            f"WHEN {k} % 29 = 0 THEN concat({zip_code}, chr(10)) ELSE {zip_code} END"
        )
        rating = f"CASE WHEN {k} % 31 = 0 THEN '9' ELSE {rating} END"
    cols = [
        f"{k} AS src_key",
        f"{facility} AS facility_id",
        f"concat('  ', s.s_name, ' ') AS facility_name",
        f"concat({_text(k)}, ' Main St  ') AS address",
        "concat(' ', n.n_name, ' City') AS citytown",
        f"concat('S', {_text('n.n_regionkey')}, ' ') AS state",
        f"{zip_code} AS zip_code",
        "concat(n.n_name, ' County', chr(9), ' ') AS countyparish",
        f"concat(' 555-', lpad({_text(f'{k} % 10000')}, 4, '0')) AS telephone_number",
        f"CASE {k} % 3 WHEN 0 THEN 'Acute Care Hospitals' WHEN 1 THEN ' Critical Access Hospitals ' "
        "ELSE 'Childrens' END AS hospital_type",
        f"CASE {k} % 4 WHEN 0 THEN 'Proprietary' WHEN 1 THEN 'Government - State ' "
        "WHEN 2 THEN ' Voluntary non-profit - Private' ELSE 'Physician' END AS hospital_ownership",
        f"CASE {k} % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS emergency_services",
        f"CASE {k} % 4 WHEN 0 THEN 'Y' WHEN 1 THEN '' WHEN 2 THEN 'y' ELSE 'N' END "
        "AS meets_criteria_for_birthing_friendly_designation",
        f"{rating} AS hospital_overall_rating",
    ]
    salt = 1
    for out, raw, rule in HOSPITAL_COLUMNS:
        if raw == "hospital_overall_rating_footnote" or rule == "blank_to_null":
            cols.append(_footnote(k, salt, raw))
        elif rule == "int" and raw != "hospital_overall_rating":
            if raw.endswith("_group_measure_count"):
                cols.append(
                    f"CASE WHEN {k} % 7 = {salt % 7} THEN 'Not Available' ELSE '8' END AS {raw}"
                )
            else:
                cols.append(_measure(k, salt, raw))
        else:
            continue
        salt += 1
    return (
        "SELECT " + ",\n  ".join(cols) + "\nFROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"
    )


def int_text() -> str:
    """Lineitem quantity as text in a form chosen by line number and order key."""
    q = "CAST(l_quantity AS BIGINT)"
    plain = _text(q)
    return (
        "SELECT l_orderkey, l_linenumber, CASE "
        "WHEN l_orderkey % 13 = 0 THEN '' "
        f"WHEN l_orderkey % 11 = 0 THEN concat('0x', {plain}) "
        f"WHEN l_linenumber = 1 THEN {plain} "
        f"WHEN l_linenumber = 2 THEN concat({plain}, '.5') "
        f"WHEN l_linenumber = 3 THEN concat({plain}, 'e1') "
        f"WHEN l_linenumber = 4 THEN concat('1_', {plain}) "
        f"WHEN l_linenumber = 5 THEN concat(' ', {plain}, chr(9)) "
        "WHEN l_linenumber = 6 THEN 'Not Available' "
        f"ELSE concat('-', {plain}, '.5') END AS v_text FROM lineitem"
    )


def padded_priority() -> str:
    """Orders priority padded, blanked or tab-prefixed by key."""
    return (
        "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_orderpriority "
        "WHEN 1 THEN concat('  ', o_orderpriority, ' ') WHEN 2 THEN '' WHEN 3 THEN '   ' "
        "ELSE concat(chr(9), o_orderpriority) END AS priority_raw FROM orders"
    )


def status_flags() -> str:
    """Orders status spelled Yes / No / other."""
    return (
        "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'yes' "
        "WHEN o_orderstatus = 'F' THEN 'Yes' WHEN o_orderstatus = 'O' THEN 'No' "
        "ELSE o_orderstatus END AS status_raw FROM orders"
    )


def brand_flags() -> str:
    """Part flag column spelled Y / empty / other."""
    return (
        "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN '' "
        "WHEN 2 THEN concat('Y', substr(p_brand, 7, 1)) ELSE 'N' END AS flag_raw FROM part"
    )


def zip_text() -> str:
    """Customer key as five-character text, some short, some null, some with a trailing newline."""
    z = f"lpad({_text('c_custkey % 100000')}, 5, '0')"
    return (
        "SELECT c_custkey, CASE WHEN c_custkey % 29 = 0 THEN NULL "
        f"WHEN c_custkey % 19 = 0 THEN {_text('c_custkey % 10000')} "
        f"WHEN c_custkey % 23 = 0 THEN concat({z}, chr(10)) ELSE {z} END AS zip5 FROM customer"
    )


def nullable_tax() -> str:
    """Lineitem with the tax nulled on line 3 and the discount nulled on line 5."""
    return (
        "SELECT l_orderkey, l_linenumber, "
        "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_discount END AS l_discount, "
        "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax END AS l_tax FROM lineitem"
    )


def part_distributions() -> str:
    """One catalog distribution per part; dataset = partkey div 100 (as text)."""
    ds = "CAST(floor(p_partkey / 100) AS BIGINT)"
    year = _text("1995 + p_size % 30")
    return (
        f"SELECT p_partkey, {ds} AS ds_num, {_text(ds)} AS ds, "
        f"concat('dist-', {_text('p_partkey')}) AS identifier, p_name AS title, "
        "CASE p_partkey % 6 WHEN 0 THEN 'text/csv' WHEN 1 THEN 'text/csv' WHEN 2 THEN 'application/zip' "
        "WHEN 3 THEN 'application/pdf' WHEN 4 THEN 'TEXT/CSV' ELSE 'application/x-zip-compressed' END AS media_type, "
        "CASE p_partkey % 5 WHEN 0 THEN 'zip' WHEN 1 THEN 'Zip' WHEN 2 THEN 'pdf' WHEN 3 THEN 'csv' "
        "ELSE NULL END AS format, "
        "CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN '' "
        f"ELSE concat('https://files.example.org/p/', {_text('p_partkey')}) END AS url, "
        "CASE WHEN p_partkey % 13 = 0 THEN 'n/a' WHEN p_partkey % 17 = 0 THEN NULL "
        f"ELSE concat({year}, '-01-01/', {year}, '-12-31') END AS temporal "
        "FROM part"
    )


def specs() -> str:
    """Dataset specs from supplier; ids are nation keys as text (prefix collisions 1, 10..19)."""
    k = "s_suppkey"
    return (
        f"SELECT {k} AS pos, concat('ds_', {_text(k)}) AS key, "
        f"CASE {k} % 8 WHEN 0 THEN 'socrata' WHEN 1 THEN 'healthcare_gov' WHEN 2 THEN 'dkan_provider_data' "
        "WHEN 3 THEN 'dkan_data_api_bulk' WHEN 4 THEN 'dkan_medicaid_bulk' WHEN 5 THEN 'dkan_open_payments_bulk' "
        "WHEN 6 THEN 'dkan_healthcare_gov_zip' ELSE 'ftp_mirror' END AS source, "
        "concat('Dataset ', s_name) AS description, "
        f"concat('grp_', {_text('s_nationkey % 3')}) AS group_name, "
        f"CASE WHEN {k} % 5 = 1 THEN NULL WHEN {k} % 5 = 2 THEN '' ELSE {_text('s_nationkey')} END AS dataset_id, "
        f"CASE WHEN {k} % 6 = 0 THEN 'data.medicaid.gov' ELSE NULL END AS domain, "
        f"CASE WHEN {k} % 4 = 0 THEN concat('/api/items_', {_text('s_nationkey')}, '.json') ELSE NULL END AS path, "
        f"CASE WHEN {k} % 3 = 0 THEN CAST(2020 + {k} % 5 AS INT) ELSE NULL END AS year "
        "FROM supplier"
    )


def year_requests() -> str:
    """Catalog lookups by dataset id and year, one per nation (ids collide as prefixes)."""
    return (
        f"SELECT concat('req_', {_text('n_nationkey')}) AS key, {_text('n_nationkey')} AS dataset_id, "
        "CAST(1995 + (n_nationkey * 7) % 30 AS INT) AS year FROM nation"
    )


def provider_rows() -> str:
    """B8 columns: customer x nation, with a second (mailing) nation."""
    k = "c.c_custkey"
    return (
        f"SELECT {k} AS c_custkey, c.c_name, c.c_mktsegment, "
        f"CASE WHEN {k} % 97 = 5 THEN NULL ELSE lpad({_text(k)}, 10, '0') END AS number, "
        f"CASE WHEN {k} % 31 = 2 THEN 'NPI-9' WHEN {k} % 3 = 0 THEN 'NPI-1' ELSE 'NPI-2' END AS enumeration_type, "
        f"concat('First', {_text(f'{k} % 50')}) AS first_name, c.c_name AS last_name, "
        "concat(c.c_mktsegment, ' Org') AS organization_name, 'A' AS status, "
        f"concat({_text(k)}, ' Main St') AS address_1, n.n_name AS city, "
        f"concat('S', lpad({_text('n.n_nationkey')}, 2, '0')) AS state, "
        f"lpad({_text(f'{k} % 100000')}, 5, '0') AS postal_code, "
        f"concat('City', {_text(f'{k} % 25')}) AS mail_city, "
        f"concat('S', lpad({_text(f'{k} % 25')}, 2, '0')) AS mail_state, "
        "concat('T', substr(c.c_mktsegment, 1, 3)) AS tax_code "
        "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"
    )


def declared_sources() -> str:
    """A sources list that drifted from the specs: some missing, some stale, one extra."""
    s = specs()
    return (
        f"SELECT concat('cms_', key) AS name, description FROM ({s}) s WHERE pos % 13 <> 0\n"
        f"UNION ALL SELECT concat('cms_', key, '_old') AS name, description FROM ({s}) s WHERE pos % 17 = 0\n"
        "UNION ALL SELECT 'cms_nppes_providers' AS name, 'Organizations swept state by state' AS description"
    )


def npi_requests() -> str:
    """Lookup ids from orders: the customer key zero-padded to 10, some malformed."""
    return (
        "SELECT o_orderkey, CASE WHEN o_orderkey % 23 = 0 THEN concat('abc', "
        f"{_text('o_custkey')}) WHEN o_orderkey % 29 = 0 THEN {_text('o_custkey % 100000')} "
        f"ELSE lpad({_text('o_custkey')}, 10, '0') END AS npi FROM orders"
    )


def late_props() -> str:
    """Event props as records; every 1000th event (id mod 1000 = 999) carries a late extra key."""
    return (
        "SELECT event_id, CASE WHEN event_id % 1000 = 999 THEN concat(substr(props, 1, length(props) - 1), "
        f"', \"late\": \"v', {_text('event_id')}, '\"}}') ELSE props END AS body FROM events"
    )


def odd_records() -> str:
    """Customer records whose member names are no identifiers, some nested; ``VOID`` is null or a flag, ``mixed`` number or text."""
    k = _text("c_custkey")
    return (
        f"SELECT c_custkey, concat('{{\":@id\": ', {k}, ', \"rate, pct\": ', {_text('c_custkey % 7')}, '.5, \"it''s <b>: x\": \"v', "
        f"{_text('c_custkey % 3')}, '\", \"VOID\": ', CASE WHEN c_custkey % 5 = 0 THEN 'true' ELSE 'null' END, "
        f"', \"mixed?\": ', CASE WHEN c_custkey % 2 = 0 THEN {k} ELSE '\"text\"' END, "
        f"', \"a`b\": {{\"x: y\": ', {k}, ', \"q, r\": [1, ', {_text('c_custkey % 11')}, ']}}}}') AS body FROM customer"
    )


def noted_parts() -> str:
    """Parts with a note that holds line breaks, quotes and delimiters."""
    return (
        "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN concat('line one of ', p_name, chr(10), 'line two, ', p_brand) "
        "WHEN 1 THEN concat('5\" ', p_name) WHEN 2 THEN concat('\"', p_name, '\"', chr(10), chr(10), '\"') "
        "WHEN 3 THEN p_name ELSE concat(p_brand, ',', chr(10)) END AS note, p_size FROM part"
    )
