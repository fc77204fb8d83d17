"""Dataset specs: scan, rules, routing, load plan, source sync."""

from __future__ import annotations

from meridian.operators import specs as sp
from meridian.plans import fixtures
from meridian.plans.registry import ORACLES, query
from meridian.sources.tables import register


def _specs(spark, sf_dir):
    register(spark, sf_dir, "supplier")
    return spark.sql(fixtures.specs())


@query(
    "spec_scan",
    "SELECT pos, key, source, description, group_name, dataset_id, coalesce(domain, 'data.cms.gov') AS domain, "
    f"path, year FROM ({fixtures.specs()}) s",
)
def q_spec_scan(spark, sf_dir):
    return sp.scan_specs(_specs(spark, sf_dir))


def _oracle_rules() -> str:
    vals = [f"('{s}', '{f}', 'required')" for s, (req, _) in sp.FIELD_RULES.items() for f in req]
    vals += [f"('{s}', '{f}', 'forbidden')" for s, (_, forb) in sp.FIELD_RULES.items() for f in forb]
    return "rules(source, field, rule) AS (VALUES " + ", ".join(vals) + ")"


_SRC_LIST = ", ".join(f"'{s}'" for s in sp.SOURCES)


@query(
    "spec_rule_violations",
    f"WITH s AS ({fixtures.specs()}),\n"
    "f AS (SELECT key, source, 'dataset_id' AS field, dataset_id IS NULL AS is_null, "
    "(dataset_id IS NULL OR dataset_id = '') AS falsy FROM s "
    "UNION ALL SELECT key, source, 'path', path IS NULL, (path IS NULL OR path = '') FROM s "
    "UNION ALL SELECT key, source, 'year', year IS NULL, (year IS NULL OR year = 0) FROM s),\n"
    + _oracle_rules() + "\n"
    "SELECT f.key, f.source, f.field, r.rule AS kind FROM f JOIN rules r ON f.source = r.source AND f.field = r.field "
    "WHERE (r.rule = 'required' AND f.falsy) OR (r.rule = 'forbidden' AND NOT f.is_null)\n"
    f"UNION ALL SELECT key, source, 'source', 'unknown_source' FROM s WHERE source IS NULL OR source NOT IN ({_SRC_LIST})\n"
    "UNION ALL SELECT key, source, 'key', 'duplicate_key' FROM s WHERE key IN "
    "(SELECT key FROM s GROUP BY key HAVING count(*) > 1)",
)
def q_spec_rule_violations(spark, sf_dir):
    return sp.rule_violations(_specs(spark, sf_dir))


def _oracle_routes() -> str:
    vals = ", ".join(
        f"('{s}', '{loader}', {('NULL' if host is None else repr(host))})" for s, (loader, host) in sp.ROUTES.items()
    )
    return f"routes(source, loader, host) AS (VALUES {vals})"


@query(
    "route_specs",
    f"WITH s AS ({fixtures.specs()}),\n" + _oracle_routes() + "\n"
    "SELECT s.key, s.source, r.loader, coalesce(r.host, concat('https://', coalesce(s.domain, 'data.cms.gov'))) AS host "
    "FROM s JOIN routes r ON s.source = r.source",
)
def q_route_specs(spark, sf_dir):
    return sp.routed(_specs(spark, sf_dir)).select("key", "source", "loader", "host")


@query(
    "unrouted_specs",
    f"WITH s AS ({fixtures.specs()})\nSELECT key, source FROM s WHERE source IS NULL OR source NOT IN ({_SRC_LIST})",
)
def q_unrouted_specs(spark, sf_dir):
    return sp.unrouted(_specs(spark, sf_dir)).select("key", "source")


def _oracle_violation_keys() -> str:
    sql = ORACLES["spec_rule_violations"]
    return f"v AS (SELECT DISTINCT key FROM ({sql}) vv)"


def _oracle_url() -> str:
    out = "CASE s.source"
    for source, tmpl in sp.URL_TEMPLATES.items():
        parts, rest = [], tmpl
        while rest:
            i = rest.find("{")
            if i < 0:
                parts.append(f"'{rest}'")
                break
            if i:
                parts.append(f"'{rest[:i]}'")
            j = rest.index("}", i)
            name = rest[i + 1:j]
            parts.append("hh.host" if name == "host" else f"s.{name}")
            rest = rest[j + 1:]
        out += f" WHEN '{source}' THEN concat({', '.join(parts)})"
    return out + " END"


@query(
    "load_plan",
    f"WITH s AS ({fixtures.specs()}),\n" + _oracle_violation_keys() + ",\n" + _oracle_routes() + ",\n"
    "hh AS (SELECT s.key, r.loader, coalesce(r.host, concat('https://', coalesce(s.domain, 'data.cms.gov'))) AS host "
    "FROM s JOIN routes r ON s.source = r.source)\n"
    "SELECT s.pos, s.key, concat('cms_', s.key) AS asset_name, s.group_name, s.description, s.source, hh.loader, "
    + _oracle_url() + " AS entry_url FROM s JOIN hh ON s.key = hh.key WHERE s.key NOT IN (SELECT key FROM v)",
)
def q_load_plan(spark, sf_dir):
    return sp.load_plan(_specs(spark, sf_dir))


_SWEEP_EXTRA = ("cms_nppes_providers", "Organizations swept state by state", "ds_1")


@query(
    "sources_in_sync",
    f"WITH s AS ({fixtures.specs()}),\n"
    "e AS (SELECT concat('cms_', key) AS name, description FROM s UNION ALL "
    f"SELECT '{_SWEEP_EXTRA[0]}', '{_SWEEP_EXTRA[1]}' FROM s WHERE key = '{_SWEEP_EXTRA[2]}'),\n"
    f"dd AS ({fixtures.declared_sources()})\n"
    "SELECT name, description, 'missing_from_sources' AS problem FROM "
    "(SELECT name, description FROM e EXCEPT ALL SELECT name, description FROM dd) a\n"
    "UNION ALL SELECT name, description, 'not_in_registry' AS problem FROM "
    "(SELECT name, description FROM dd EXCEPT ALL SELECT name, description FROM e) b",
)
def q_sources_in_sync(spark, sf_dir):
    """K10+V9: the registered source list against the registry projection, both directions."""
    specs = _specs(spark, sf_dir)
    extras = spark.createDataFrame([_SWEEP_EXTRA], "name string, description string, after_key string")
    expected = sp.source_table(specs, extras)
    declared = spark.sql(fixtures.declared_sources())
    return sp.sources_diff(declared, expected)
