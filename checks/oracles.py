"""DuckDB SQL for each query, in the plain form: one filtered scan per label, then unions.

Survivors of de-duplication are picked by `row_number()` under the order the operators state:
named columns first, nulls last, then every other column, nulls first. Side columns of matches
compare as they read once store aliases are rewritten, which is the text that the warehouse shows.
"""

from __future__ import annotations

from .fixtures import FX_MATCH_LIBRARY, FX_PAIRS, FX_REVIEWS, FX_SNAPSHOTS
from .queries import LOAD_DAY, NEXT_DAY, RUN_DAY

PAIR = ["uuid_a", "uuid_b", "sku_uuid_a", "sku_uuid_b", "score", "base_source_store",
        "comp_source_store", "match_timestamp", "match_source", "type", "segment"]
PAIR_LIST = ", ".join(PAIR)
KEYS = ["sku_uuid_a", "sku_uuid_b"]
SWAP = {"uuid_a": "uuid_b", "sku_uuid_a": "sku_uuid_b", "base_source_store": "comp_source_store"}
SWAP |= {b: a for a, b in SWAP.items()}
ID_COLUMNS = ["base_upc", "base_sku", "comp_upc", "comp_sku", "base_source_store",
              "comp_source_store"]
# Word lists, labels and output columns, which must equal the data.
PLACEHOLDERS = ("'', '-', '_', '.', 'null', 'none', 'all', 'undefined', '●', '?', '¿', '0', '1',"
                " 'na', 'n/a', 'nan'")

LIB = ("fx_match_library", FX_MATCH_LIBRARY)
REV = ("fx_reviews", FX_REVIEWS)
PRS = ("fx_pairs", FX_PAIRS)
SNP = ("fx_snapshots", FX_SNAPSHOTS)


def with_(*parts: tuple[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts) + "\n" + body


# ---- Expressions ------------------------------------------------------------------------

def uuid_sql(upc: str, sku: str, store: str) -> str:
    words = f"string_split({store}, '_')"
    return (f"({upc} || '<>' || {sku} || '<>' || CASE WHEN len({words}) >= 2 "
            f"THEN list_extract({words}, len({words}) - 1) END || '<>' || "
            f"list_extract({words}, len({words})))")


def key_sql(uuid: str, prefer: str) -> str:
    """`prefer`: upc, sku, or a condition under which the SKU goes first."""
    parts = f"string_split(lower(regexp_replace({uuid}, '^0*', '')), '<>')"
    upc, sku, source, store = (f"list_extract({parts}, {i})" for i in range(1, 5))
    last = {"upc": upc, "sku": sku}.get(prefer, f"CASE WHEN {prefer} THEN {sku} ELSE {upc} END")
    return (f"(CASE WHEN {sku} IN ({PLACEHOLDERS}) THEN {upc} "
            f"WHEN {upc} IN ({PLACEHOLDERS}) THEN {sku} ELSE {last} END "
            f"|| '<>' || {source} || '<>' || {store})")


def store_sql(uuid: str) -> str:
    parts = f"string_split({uuid}, '<>')"
    return f"(list_extract({parts}, 3) || '<>' || list_extract({parts}, 4))"


def epoch_sql(day: str, month: str, year: str) -> str:
    return (f"CAST(epoch(try_strptime({day} || '-' || {month} || '-' || {year}, '%d-%m-%Y')) "
            "AS BIGINT)")


def keyed_sql(source: str, prefer: str = "upc") -> str:
    return (f"SELECT * EXCLUDE (base_source_store, comp_source_store), "
            f"{key_sql('uuid_a', prefer)} AS sku_uuid_a, {key_sql('uuid_b', prefer)} AS sku_uuid_b, "
            f"{store_sql('uuid_a')} AS base_source_store, "
            f"{store_sql('uuid_b')} AS comp_source_store FROM {source}")


def rekeyed_sql(source: str, prefer: str) -> str:
    """Join keys anew where the preference is a condition, which may need labels of the row."""
    if prefer in ("upc", "sku"):
        return source
    return (f"(SELECT * REPLACE ({key_sql('uuid_a', prefer)} AS sku_uuid_a, "
            f"{key_sql('uuid_b', prefer)} AS sku_uuid_b) FROM {source})")


def bare_sql(uuid: str) -> str:
    parts = f"string_split({uuid}, '<>')"
    return (f"(regexp_replace(lower({parts}[1]), '^0*', '') IN ({PLACEHOLDERS}) "
            f"AND lower({parts}[2]) IN ({PLACEHOLDERS}))")


BARE = f"coalesce({bare_sql('uuid_a')} OR {bare_sql('uuid_b')}, false)"


def filled_sql(source: str) -> str:
    columns = ", ".join(f"coalesce({c}, '') AS {c}" for c in ID_COLUMNS)
    return f"SELECT * REPLACE ({columns}) FROM {source}"


def uuids_sql(source: str) -> str:
    return (f"SELECT *, {uuid_sql('base_upc', 'base_sku', 'base_source_store')} AS uuid_a, "
            f"{uuid_sql('comp_upc', 'comp_sku', 'comp_source_store')} AS uuid_b FROM {source}")


def alias_sql(column: str) -> str:
    return f"replace({column}, 'chewyinternal', 'chewy')"


SIDE_COLUMNS = list(SWAP)
ALIASED = ", ".join(f"{alias_sql(c)} AS {c}" for c in SIDE_COLUMNS)


# ---- Pair operators ---------------------------------------------------------------------

def survivors_sql(source: str, columns: list[str], keys: list[str], order: list[str],
                  aliased: bool = False) -> str:
    """`aliased` compares side columns as they read once the alias is rewritten."""
    def shown(c):
        return alias_sql(c) if aliased and c in SIDE_COLUMNS else c
    ranks = [f"{shown(c)} NULLS LAST" for c in order]
    ranks += [f"{shown(c)} NULLS FIRST" for c in columns if c not in keys and c not in order]
    return (f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY {', '.join(ranks)}) AS place FROM {source}) "
            "WHERE place = 1")


def pair_survivors(source: str, priority: bool = False, aliased: bool = False) -> str:
    columns = PAIR + ["priority"] * priority
    order = ["priority"] * priority + ["match_timestamp"]
    return survivors_sql(source, columns, KEYS, order, aliased)


def mirror_sql(source: str, columns: list[str]) -> str:
    swapped = ", ".join(f"{SWAP[c]} AS {c}" if c in SWAP else c for c in columns)
    return (f"SELECT {', '.join(columns)} FROM {source} UNION ALL "
            f"SELECT {swapped} FROM {source}")


def oriented_sql(source: str, columns: list[str]) -> str:
    turn = "coalesce(sku_uuid_a > sku_uuid_b, sku_uuid_a IS NOT NULL AND sku_uuid_b IS NULL)"
    shown = ", ".join(f"CASE WHEN {turn} THEN {SWAP[c]} ELSE {c} END AS {c}" if c in SWAP else c
                      for c in columns)
    return f"SELECT {shown} FROM {source}"


# ---- Library ----------------------------------------------------------------------------

LIVE = "match_status = 'product_found' AND (deleted_date IS NULL OR deleted_date = '')"
DELETED = "(deleted_date IS NOT NULL OR deleted_date <> '')"
COMPANY = {"pets": "company_code IN ('chewy', 'petco')",
           "grocery": "company_code IN ('wholefoods', 'farmstead', 'imperfect')",
           "office_supplies": "company_code = 'staples'"}
SEGMENT_CASE = ("CASE " + " ".join(f"WHEN {w} THEN '{s}'" for s, w in COMPANY.items()) + " END")

_LEGACY = "model_used IN ('ManualInternal', 'ManualExternal', 'MLT')"
_MANUAL = "model_used LIKE '%Manual-%'"
PETS_BRANCHES = [
    (f"{COMPANY['pets']} AND {_LEGACY} AND match = 'exact'", "legacy", "exact_match"),
    (f"{COMPANY['pets']} AND {_LEGACY} AND match = 'similar'", "legacy", "similar_match"),
    (f"{COMPANY['pets']} AND {_MANUAL} AND match = 'exact'", "manual", "exact_match"),
    (f"{COMPANY['pets']} AND {_MANUAL} AND match = 'similar'", "manual", "similar_match"),
    (f"{COMPANY['pets']} AND model_used IN ('SimEngineAutov1', 'SimEnginev1') "
     "AND match = 'exact'", "legacy_ml", "exact_match"),
    (f"{COMPANY['pets']} AND model_used IN ('ml_v1.0', 'ml', 'btfastlane-ml', "
     "'btfastlane-ml_v1.0', 'btfastlaneMock-ml') AND match = 'exact'", "fastlane", "exact_match"),
    (f"{COMPANY['pets']} AND model_used IN ('UPCMatch', 'upc', 'btfastlane-upc') "
     "AND match = 'exact'", "upc_legacy", "exact_match"),
    ("company_code = 'btfastlane' AND customer_review_state IN "
     "('both_customer_manager_verified', 'customer_verified') AND match = 'exact'",
     "fastlane", "exact_match"),
]
GROCERY_BRANCHES = [(f"{COMPANY['grocery']} AND match = 'exact'", "legacy", "exact_match")]
OFFICE_BRANCHES = [
    (f"{COMPANY['office_supplies']} AND model_used LIKE '%{word}%' AND match = '{kind}'",
     source, label)
    for word, source in (("fastlane", "fastlane"), ("Manual", "manual"))
    for kind, label in (("exact", "exact_match"), ("equivalent", "similar_match"))]
REJECT_WORDS = [("lower(model_used) LIKE '%manual%'", "manual"),
                ("(lower(model_used) LIKE '%fastlane%' OR lower(model_used) LIKE '%ml%')",
                 "fastlane_customer_scrape_rejected"),
                ("lower(model_used) LIKE '%upc%'", "upc"),
                ("lower(model_used) LIKE '%transitive%'", "transitive")]


def branches_sql(source: str, branches: list[tuple[str, str, str]], segment: str,
                 also: str = "true", extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{label}' AS type, '{match_source}' AS match_source, "
        f"'{segment}' AS segment{extra} FROM {source} WHERE {where} AND {also}"
        for where, match_source, label in branches)


def library_parts(prefer: str = "upc", strict: bool = False) -> list[tuple[str, str]]:
    """CTEs up to `lib_matches` and `lib_rejects`, both labelled with a priority."""
    deleted = "deleted_date IS NOT NULL AND deleted_date <> ''" if strict else DELETED
    sku = "comp_sku <> ''" if strict else "true"
    plain = prefer if prefer in ("upc", "sku") else "upc"
    return [
        LIB,
        ("lib_filled", filled_sql("(SELECT * FROM fx_match_library WHERE company_code <> 'agg_ml')")),
        ("lib_uuids", uuids_sql("lib_filled")),
        ("lib", f"SELECT * EXCLUDE (match_date), CAST(match_date AS BIGINT) AS match_timestamp "
                f"FROM ({keyed_sql('lib_uuids', plain)})"),
        ("live", f"SELECT * FROM lib WHERE {LIVE}"),
        ("lib_matches", f"SELECT {PAIR_LIST}, priority FROM " + rekeyed_sql(
            "(" + " UNION ALL ".join([
                branches_sql("live", GROCERY_BRANCHES, "grocery", sku, ", 0 AS priority"),
                branches_sql("live", PETS_BRANCHES, "pets", "true", ", 1 AS priority"),
                branches_sql("live", OFFICE_BRANCHES, "office_supplies", sku, ", 2 AS priority"),
            ]) + ")", prefer)),
        ("deleted", f"SELECT *, {SEGMENT_CASE} AS segment, 'not_a_match' AS type FROM lib "
                    f"WHERE {deleted}"),
        ("lib_rejects", f"SELECT {PAIR_LIST}, 0 AS priority FROM " + rekeyed_sql(
            "(" + " UNION ALL ".join(
                f"SELECT *, '{s}' AS match_source FROM deleted WHERE segment IS NOT NULL AND {w}"
                for w, s in REJECT_WORDS) + ")", prefer)),
    ]


# ---- Reviews ----------------------------------------------------------------------------

ANSWERS = [
    ("answer IN ('exact_match', 'exact_match_dq_issue', 'exact_match_with_image')", "exact_match"),
    ("answer IN ('not_a_match', 'not_match_image', 'not_match_dq_issue')", "not_a_match"),
    ("answer NOT IN ('exact_match', 'exact_match_dq_issue', 'exact_match_with_image', "
     "'not_a_match', 'not_match_image', 'not_match_dq_issue', 'unsure')", "similar_match"),
]
QUEUES = [
    ("NOT (queue_name LIKE '%grocery%' OR queue_name LIKE '%staples%')", "pets"),
    ("queue_name LIKE '%grocery%'", "grocery"),
    ("queue_name LIKE '%staples%'", "office_supplies"),
]


def routed_reviews_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{label}' AS type, '{segment}' AS segment FROM {source} "
        f"WHERE {answer} AND {queue}"
        for answer, label in ANSWERS for queue, segment in QUEUES)


WORKFLOWS = "workflow NOT IN ('internal-auditor', 'fastlane')"


def review_parts(prefer: str = "upc", workflows: str = WORKFLOWS, where: str = "true",
                 alias_rejects: bool = False) -> list[tuple[str, str]]:
    """CTEs up to `rev_matches` and `rev_rejects`, de-duplicated and labelled."""
    plain = prefer if prefer in ("upc", "sku") else "upc"
    return [
        REV,
        ("rev_filled", filled_sql(f"(SELECT * FROM fx_reviews WHERE {workflows})")),
        ("rev_uuids", uuids_sql("rev_filled")),
        ("rev", "SELECT *, CAST(TRY_CAST(match_date AS INTEGER) AS BIGINT) AS match_timestamp, "
                f"'fastlane' AS match_source FROM ({keyed_sql('rev_uuids', plain)})"),
        ("rev_routed", f"SELECT {PAIR_LIST} FROM " + rekeyed_sql(
            f"({routed_reviews_sql('rev')})", prefer) + f" WHERE {where}"),
        ("rev_matches", "SELECT *, 3 AS priority FROM (" + pair_survivors(
            "(SELECT * FROM rev_routed WHERE type <> 'not_a_match')", aliased=True) + ")"),
        ("rev_rejects", "SELECT *, 1 AS priority FROM (" + pair_survivors(
            "(SELECT * FROM rev_routed WHERE type = 'not_a_match')", aliased=alias_rejects) + ")"),
    ]


# ---- Feeds ------------------------------------------------------------------------------

FEEDS = {"transitive": ("transitive", 4), "exact_desc": ("exact_desc_match", 5), "upc": ("upc", 6)}
THREE_DOMAINS = "domain IN ('pets', 'office_supplies', 'grocery')"


def feed_parts(feed: str, prefer: str = "upc", domains: str | None = None,
               where: str = "true") -> list[tuple[str, str]]:
    """CTEs up to `feed_<name>`; without the fixture itself. where: of raw pairs."""
    source, priority = FEEDS[feed]
    limit = domains or ("true" if feed == "exact_desc" else THREE_DOMAINS)
    edge = ["uuid_a", "uuid_b", "match_timestamp", "score", "segment"]
    return [
        (f"edges_{feed}", "SELECT least(uuid_a, uuid_b) AS uuid_a, greatest(uuid_a, uuid_b) AS "
                          f"uuid_b, {epoch_sql('day', 'month', 'year')} AS match_timestamp, score, "
                          f"domain AS segment FROM fx_pairs WHERE feed = '{feed}' AND {limit} "
                          f"AND {where}"),
        (f"unique_{feed}", survivors_sql(f"edges_{feed}", edge, ["uuid_a", "uuid_b"],
                                         ["match_timestamp"])),
        (f"feed_{feed}", f"SELECT {PAIR_LIST}, {priority} AS priority FROM (SELECT *, "
                         f"'{source}' AS match_source, 'exact_match' AS type FROM "
                         f"({keyed_feed_sql(f'unique_{feed}', prefer)}))"),
    ]


def keyed_feed_sql(source: str, prefer: str) -> str:
    return (f"SELECT *, {key_sql('uuid_a', prefer)} AS sku_uuid_a, "
            f"{key_sql('uuid_b', prefer)} AS sku_uuid_b, "
            f"{store_sql('uuid_a')} AS base_source_store, "
            f"{store_sql('uuid_b')} AS comp_source_store FROM {source}")


KEYED_PAIRS = [PRS, ("keyed", f"SELECT {PAIR_LIST} FROM (SELECT *, 'upc' AS match_source, "
                              "'exact_match' AS type, domain AS segment, "
                              f"{epoch_sql('day', 'month', 'year')} AS match_timestamp FROM "
                              f"({keyed_feed_sql('fx_pairs', 'upc')}))")]


# ---- Warehouse --------------------------------------------------------------------------

def family_parts(prefer: str = "upc", domains: str | None = None, raw_pairs: str = "true",
                 workflows: str = WORKFLOWS, where: str = "true",
                 alias_rejects: bool = False) -> list[tuple[str, str]]:
    """where: of labelled pairs; raw_pairs: of the feeds' rows."""
    parts = library_parts(prefer) + review_parts(prefer, workflows, where, alias_rejects) + [PRS]
    for feed in FEEDS:
        parts += feed_parts(feed, prefer, domains, raw_pairs)
    columns = f"{PAIR_LIST}, priority"
    parts.append(("families", " UNION ALL ".join(
        f"SELECT {columns} FROM {name} WHERE {where}"
        for name in ("lib_matches", "rev_matches", *(f"feed_{f}" for f in FEEDS)))))
    parts.append(("all_rejects", f"SELECT {columns} FROM lib_rejects WHERE {where} UNION ALL "
                                 f"SELECT {columns} FROM rev_rejects"))
    return parts


def bare_pairs_sql() -> str:
    """Every labelled pair with a product that has no id, before any de-duplication."""
    parts = library_parts() + review_parts() + [PRS]
    for feed in FEEDS:
        parts += feed_parts(feed)
    columns = f"{PAIR_LIST}, priority"
    sources = [f"SELECT {columns} FROM {n}" for n in ("lib_matches", "lib_rejects")]
    sources.append(f"SELECT {PAIR_LIST}, CASE WHEN type = 'not_a_match' THEN 1 ELSE 3 END "
                   "AS priority FROM rev_routed")
    sources += [f"SELECT {PAIR_LIST}, {priority} AS priority FROM (SELECT *, '{source}' AS "
                f"match_source, 'exact_match' AS type FROM "
                f"({keyed_feed_sql(f'edges_{feed}', 'upc')}))"
                for feed, (source, priority) in FEEDS.items()]
    return with_(*parts, body=f"SELECT * FROM ({' UNION ALL '.join(sources)}) WHERE {BARE}")


def on_days_sql(sql: str) -> str:
    """The rows, once with each of the two load dates."""
    return " UNION ALL ".join(
        "SELECT *, '{}' AS year, '{}' AS month, '{}' AS day FROM ".format(*day.split("-"))
        + f"({sql})" for day in (LOAD_DAY, NEXT_DAY))


def warehouse_sql(prefer: str = "upc", prune: bool = False, undirected: bool = False,
                  alias_rejects: bool = False, written: str | None = None, **limits) -> str:
    year, month, day = LOAD_DAY.split("-")
    parts = family_parts(prefer, alias_rejects=alias_rejects, **limits)
    columns = PAIR + ["priority"]
    rewritten = f"SELECT * REPLACE ({ALIASED}) FROM "
    if undirected:
        parts += [
            ("turned", oriented_sql(f"({rewritten} families)", columns)),
            ("matches", pair_survivors("turned", priority=True)),
            ("turned_rejects", oriented_sql("all_rejects", columns)),
            ("rejects", pair_survivors("turned_rejects", priority=True)),
        ]
    else:
        reject_source = f"({rewritten} all_rejects)" if alias_rejects else "all_rejects"
        parts += [
            ("matches_once", pair_survivors("families", priority=True, aliased=True)),
            ("matches", pair_survivors(f"({rewritten} matches_once)", priority=True)),
            ("rejects", pair_survivors(reject_source, priority=True)),
        ]
    kept = "SELECT * FROM matches m"
    if prune:
        kept += (" WHERE NOT EXISTS (SELECT 1 FROM rejects r WHERE r.sku_uuid_a = m.sku_uuid_a "
                 "AND r.sku_uuid_b = m.sku_uuid_b) AND NOT EXISTS (SELECT 1 FROM rejects r "
                 "WHERE r.sku_uuid_a = m.sku_uuid_b AND r.sku_uuid_b = m.sku_uuid_a)")
    parts += [
        ("kept", kept),
        ("stamped", f"SELECT {PAIR_LIST}, '{year}' AS year, '{month}' AS month, '{day}' AS day "
                    f"FROM (SELECT {PAIR_LIST} FROM kept UNION ALL SELECT {PAIR_LIST} "
                    "FROM rejects)"),
    ]
    body = mirror_sql("stamped", PAIR + ["year", "month", "day"])
    if written:
        body = f"SELECT *, {written} AS target FROM ({body})"
    return with_(*parts, body=body)


def library_sql(body: str) -> str:
    return with_(LIB, body=body)


def reviews_sql(body: str) -> str:
    return with_(REV, body=body)


def pairs_sql(body: str) -> str:
    return with_(PRS, body=body)


def snapshots_sql(body: str) -> str:
    return with_(SNP, body=body)


def keyed_pairs_sql(body: str) -> str:
    return with_(*KEYED_PAIRS, body=body)


REVIEW_COLUMNS = ("base_upc, base_sku, comp_upc, comp_sku, base_source_store, comp_source_store, "
                  "score, CAST(match_date AS INTEGER) AS match_date, queue_name, answer, workflow")
FEED_COLUMNS = "uuid_a, uuid_b, day, month, year, score, domain"
_REVIEW_ROWS = reviews_sql(f"SELECT {REVIEW_COLUMNS} FROM fx_reviews")
_NOT_REJECTED = (" WHERE NOT EXISTS (SELECT 1 FROM lib_rejects r WHERE r.sku_uuid_a = "
                 "k.sku_uuid_a AND r.sku_uuid_b = k.sku_uuid_b)")
_NOT_REJECTED_BACK = (" AND NOT EXISTS (SELECT 1 FROM lib_rejects r WHERE r.sku_uuid_a = "
                      "k.sku_uuid_b AND r.sku_uuid_b = k.sku_uuid_a)")
_RAW_PAIR = ["feed", "uuid_a", "uuid_b", "day", "month", "year", "score", "domain"]
_LIVE_LIB = (LIB, ("live", f"SELECT * FROM fx_match_library WHERE {LIVE}"))
_Y, _M, _D = (str(int(p)) for p in RUN_DAY.split("-"))

ORACLES: dict[str, str] = {
    # Sources
    "scan_partitioned": pairs_sql("SELECT * FROM fx_pairs WHERE domain = 'pets'"),
    "scan_table": pairs_sql("SELECT * FROM fx_pairs"),
    "scan_json_dir": _REVIEW_ROWS,
    "scan_json_numbers": _REVIEW_ROWS,
    "scan_small_files": _REVIEW_ROWS,
    "resolve_types": snapshots_sql(
        "SELECT o_orderkey AS order_text, CAST(CASE WHEN run_no <> 1 THEN o_custkey END AS "
        "INTEGER) AS cust_text, CAST(run_no AS STRING) AS run_no FROM fx_snapshots"),
    "latest_partition": snapshots_sql(
        "SELECT * FROM fx_snapshots WHERE load_date = (SELECT max(load_date) FROM fx_snapshots)"),
    "latest_partition_listed": snapshots_sql(
        "SELECT * REPLACE (load_date || ' 00:00:00' AS load_date) FROM fx_snapshots WHERE "
        "run_no <> 3 AND load_date = (SELECT max(load_date) FROM fx_snapshots WHERE run_no <> 3)"),
    "latest_partition_by_parts": snapshots_sql(
        "SELECT * FROM fx_snapshots WHERE run_no = 2 AND (year, month, day) = (SELECT (year, "
        "month, day) FROM fx_snapshots WHERE run_no = 2 ORDER BY year DESC, month DESC, day DESC "
        "LIMIT 1)"),
    "latest_partition_and_run": snapshots_sql(
        "SELECT * FROM fx_snapshots WHERE (year, month, day, run_no) = (SELECT (year, month, day, "
        "run_no) FROM fx_snapshots ORDER BY year DESC, month DESC, day DESC, run_no DESC LIMIT 1)"),
    "latest_partition_within": snapshots_sql(
        "SELECT *, 'run=2' AS run, substr(load_date, 1, 7) AS load_month FROM fx_snapshots WHERE "
        "run_no = 2 AND substr(load_date, 1, 7) = (SELECT substr(max(load_date), 1, 7) FROM "
        "fx_snapshots WHERE run_no = 2)"),
    "scan_in_list": pairs_sql(
        "SELECT * FROM fx_pairs WHERE domain IN ('pets', 'toys') AND year = '1996'"),
    "scan_domains": pairs_sql(f"SELECT * FROM fx_pairs WHERE {THREE_DOMAINS}"),
    "union_sources": " UNION ALL ".join(
        f"SELECT {REVIEW_COLUMNS} FROM ({FX_REVIEWS}) WHERE feed = {i}" for i in range(4)),
    "next_run_number": snapshots_sql(
        "SELECT CASE WHEN length(r) < 2 THEN '0' || r ELSE r END AS run_no FROM (SELECT CAST("
        "coalesce(max(run_no), 0) + 1 AS STRING) AS r FROM fx_snapshots WHERE "
        f"year = {_Y} AND month = {_M} AND day = {_D})"),
    "stamp_load_date": pairs_sql(
        "SELECT * REPLACE ('2024' AS year, '01' AS month, '05' AS day) FROM fx_pairs"),
    "write_warehouse": warehouse_sql(),
    "write_warehouse_csv": warehouse_sql(),
    "write_warehouse_json": warehouse_sql(),
    "stage_json": reviews_sql(on_days_sql(
        "SELECT base_sku, match_date FROM fx_reviews WHERE CAST(match_date AS BIGINT) % 7 = 0")),
    "publish_day": on_days_sql(f"SELECT {PAIR_LIST} FROM ({warehouse_sql()})"),
    "count_metrics": f"""SELECT count(*) AS row_count,
        count(*) FILTER (sku_uuid_a IS NULL OR sku_uuid_b IS NULL) AS null_keys,
        count(*) FILTER ({BARE}) AS bare_keys,
        count(*) FILTER (type = 'exact_match') AS type_exact_match,
        count(*) FILTER (type = 'similar_match') AS type_similar_match,
        count(*) FILTER (type = 'not_a_match') AS type_not_a_match,
        count(*) FILTER (type IS NULL OR type NOT IN ('exact_match', 'similar_match',
          'not_a_match')) AS type_other
        FROM ({warehouse_sql()})""",
    "order_for_lookup": keyed_pairs_sql(f"SELECT {PAIR_LIST} FROM keyed"),
    "quarantine_by_day": on_days_sql(bare_pairs_sql()),
    "write_split": warehouse_sql(
        written="CASE WHEN type = 'not_a_match' THEN 'rejects' ELSE 'matches' END"),
    "write_split_rest": f"""SELECT * REPLACE (CASE WHEN type <> 'not_a_match' THEN type END AS type)
        FROM ({warehouse_sql(written="CASE WHEN type = 'exact_match' THEN 'exact' ELSE 'rest' END")})
        """,
    "rebalance": pairs_sql("SELECT * FROM fx_pairs"),
    "count_rows": pairs_sql("SELECT count(*) AS row_count FROM fx_pairs"),

    # Projections
    "conform": pairs_sql(f"SELECT {FEED_COLUMNS} FROM fx_pairs"),
    "drop_cols": pairs_sql("SELECT feed, uuid_a, uuid_b, score, domain FROM fx_pairs"),
    "rename_cols": pairs_sql(
        "SELECT feed, uuid_a, uuid_b, day, month, year, score AS scores, domain AS segment "
        "FROM fx_pairs"),
    "tag": pairs_sql("SELECT *, 'upc' AS match_source, 'exact_match' AS type, 'pets' AS segment "
                     "FROM fx_pairs"),
    "fill_blank": library_sql(filled_sql("fx_match_library")),
    "to_epoch_int": reviews_sql("SELECT match_date, TRY_CAST(match_date AS INTEGER) AS "
                                "match_timestamp FROM fx_reviews"),
    "lower_cols": library_sql("SELECT * REPLACE (lower(model_used) AS model_used) "
                              "FROM fx_match_library"),

    # Filters
    "exclude_values": reviews_sql(
        "SELECT * FROM fx_reviews WHERE workflow NOT IN ('internal-auditor', 'fastlane')"),
    "exclude_company": library_sql("SELECT * FROM fx_match_library WHERE company_code <> 'agg_ml'"),
    "live_rows": library_sql(f"SELECT * FROM fx_match_library WHERE {LIVE}"),
    "deleted_rows": library_sql(f"SELECT * FROM fx_match_library WHERE {DELETED}"),
    "deleted_rows_strict": library_sql(
        "SELECT * FROM fx_match_library WHERE deleted_date IS NOT NULL AND deleted_date <> ''"),
    "keep_companies": library_sql(f"SELECT * FROM fx_match_library WHERE {COMPANY['pets']}"),
    "keep_models": library_sql(
        "SELECT * FROM fx_match_library WHERE model_used IN ('ml_v1.0', 'ml', 'btfastlane-ml', "
        "'btfastlane-ml_v1.0', 'btfastlaneMock-ml')"),
    "keep_containing": library_sql(
        "SELECT * REPLACE (lower(model_used) AS model_used) FROM fx_match_library "
        f"WHERE {REJECT_WORDS[1][0]}"),
    "keep_match_kind": library_sql("SELECT * FROM fx_match_library WHERE match = 'similar'"),
    "keep_review_states": library_sql(
        "SELECT * FROM fx_match_library WHERE customer_review_state IN "
        "('both_customer_manager_verified', 'customer_verified')"),
    "non_blank": library_sql(f"SELECT * FROM ({filled_sql('fx_match_library')}) "
                             "WHERE base_sku IS NOT NULL OR base_sku <> ''"),
    "non_blank_strict": library_sql(f"SELECT * FROM ({filled_sql('fx_match_library')}) "
                                    "WHERE base_sku IS NOT NULL AND base_sku <> ''"),
    "answer_flags": reviews_sql(" UNION ALL ".join(
        f"SELECT *, '{label}' AS type FROM fx_reviews WHERE {where}" for where, label in ANSWERS)),
    "keep_types": reviews_sql(f"SELECT * FROM ({routed_reviews_sql('fx_reviews')}) "
                              "WHERE type IN ('exact_match', 'similar_match')"),

    # Scalar expressions
    "product_uuid": with_(LIB, ("filled", filled_sql("fx_match_library")), body=(
        f"SELECT uuid_a, uuid_b FROM ({uuids_sql('filled')})")),
    "join_key": pairs_sql(
        f"SELECT uuid_a, {key_sql('uuid_a', 'sku')} AS by_sku, {key_sql('uuid_a', 'upc')} AS "
        f"by_upc, {key_sql('uuid_a', chr(39).join(['domain = ', 'pets', '']))} AS by_domain "
        "FROM fx_pairs"),
    "is_placeholder": library_sql(
        f"SELECT base_upc, comp_sku, base_upc IN ({PLACEHOLDERS}) AS no_upc, "
        f"lower(comp_sku) IN ({PLACEHOLDERS}) AS no_sku FROM fx_match_library"),
    "lacks_ids": with_(LIB, ("filled", filled_sql("fx_match_library")), body=(
        f"SELECT uuid_a, regexp_replace(lower(string_split(uuid_a, '<>')[1]), '^0*', '') IN "
        f"({PLACEHOLDERS}) AND lower(string_split(uuid_a, '<>')[2]) IN ({PLACEHOLDERS}) AS bare "
        f"FROM ({uuids_sql('filled')})")),
    "add_join_keys": pairs_sql(f"SELECT *, {key_sql('uuid_a', 'sku')} AS sku_uuid_a, "
                               f"{key_sql('uuid_b', 'sku')} AS sku_uuid_b FROM fx_pairs"),
    "store_key": pairs_sql(f"SELECT *, {store_sql('uuid_a')} AS base_source_store, "
                           f"{store_sql('uuid_b')} AS comp_source_store FROM fx_pairs"),
    "parts_to_epoch": pairs_sql(f"SELECT day, month, year, {epoch_sql('day', 'month', 'year')} AS "
                                "match_timestamp FROM fx_pairs"),
    "canonical_pair": pairs_sql("SELECT * REPLACE (least(uuid_a, uuid_b) AS uuid_a, "
                                "greatest(uuid_a, uuid_b) AS uuid_b) FROM fx_pairs"),
    "orient_pairs": keyed_pairs_sql(oriented_sql("keyed", PAIR)),
    "rewrite_alias": keyed_pairs_sql(f"SELECT * REPLACE ({ALIASED}) FROM keyed"),
    "store_from_uuid": library_sql(
        "SELECT base_source_store, list_extract(string_split(base_source_store, '_'), -1) || '_' "
        "|| list_extract(string_split(base_source_store, '_'), -1) AS store FROM fx_match_library"),

    # Routing
    "route_segment": library_sql(" UNION ALL ".join(
        f"SELECT *, '{s}' AS segment FROM fx_match_library WHERE {w}"
        for s, w in COMPANY.items())),
    "route_reject_source": library_sql(" UNION ALL ".join(
        f"SELECT *, '{s}' AS match_source FROM fx_match_library WHERE {w}"
        for w, s in REJECT_WORDS)),
    "route_pets": with_(*_LIVE_LIB, body=branches_sql("live", PETS_BRANCHES, "pets")),
    "route_grocery": with_(*_LIVE_LIB, body=branches_sql("live", GROCERY_BRANCHES, "grocery")),
    "route_office": with_(*_LIVE_LIB, body=branches_sql("live", OFFICE_BRANCHES,
                                                        "office_supplies")),
    "route_reviews": reviews_sql(routed_reviews_sql("fx_reviews")),

    # Pairs
    "dedupe_uuid_pairs": pairs_sql(survivors_sql(
        "(SELECT * REPLACE (least(uuid_a, uuid_b) AS uuid_a, greatest(uuid_a, uuid_b) AS uuid_b) "
        "FROM fx_pairs)", _RAW_PAIR, ["uuid_a", "uuid_b"], ["year", "month", "day"])),
    "dedupe_pairs": keyed_pairs_sql(pair_survivors("keyed")),
    "dedupe_pairs_undirected": keyed_pairs_sql(pair_survivors(
        "(SELECT * REPLACE (least(sku_uuid_a, sku_uuid_b) AS sku_uuid_a, "
        "greatest(sku_uuid_a, sku_uuid_b) AS sku_uuid_b) FROM keyed)")),
    "earliest_per_pair": keyed_pairs_sql(
        f"SELECT {PAIR_LIST} FROM (SELECT *, rank() OVER (PARTITION BY sku_uuid_a, sku_uuid_b "
        "ORDER BY match_timestamp NULLS FIRST) AS place FROM keyed) WHERE place = 1"),
    "prune_rejected_directed": with_(*KEYED_PAIRS, *library_parts(), body=(
        "SELECT * FROM keyed k" + _NOT_REJECTED)),
    "prune_rejected": with_(*KEYED_PAIRS, *library_parts(), body=(
        "SELECT * FROM keyed k" + _NOT_REJECTED + _NOT_REJECTED_BACK)),
    "mirror_pairs": keyed_pairs_sql(mirror_sql("keyed", PAIR)),
    "union_feeds": " UNION ALL ".join(
        f"SELECT {FEED_COLUMNS} FROM ({FX_PAIRS}) WHERE feed = '{f}'" for f in FEEDS),
    "union_classes": with_(*_LIVE_LIB, body=" UNION ALL ".join([
        branches_sql("live", GROCERY_BRANCHES, "grocery"),
        branches_sql("live", PETS_BRANCHES, "pets"),
        branches_sql("live", OFFICE_BRANCHES, "office_supplies")])),
    "combine_matches": with_(*family_parts(), body=(
        f"SELECT {PAIR_LIST}, priority FROM families")),
    "combine_rejects": with_(*family_parts(), body=(
        pair_survivors("all_rejects", priority=True))),
    "matches_and_rejects": with_(*family_parts(), body=(
        f"SELECT {PAIR_LIST} FROM ({pair_survivors('families', priority=True)}) UNION ALL "
        f"SELECT {PAIR_LIST} FROM ({pair_survivors('all_rejects', priority=True)})")),

    # Flows
    "library_matches": with_(*library_parts(), body=f"SELECT {PAIR_LIST} FROM lib_matches"),
    "library_matches_strict": with_(*library_parts("sku", strict=True), body=(
        f"SELECT {PAIR_LIST} FROM lib_matches")),
    "library_rejects": with_(*library_parts(), body=f"SELECT {PAIR_LIST} FROM lib_rejects"),
    "library_pairs": with_(*library_parts(), body=(
        f"SELECT {PAIR_LIST}, priority FROM lib_matches UNION ALL "
        f"SELECT {PAIR_LIST}, priority FROM lib_rejects")),
    "review_matches": with_(*review_parts(), body=f"SELECT {PAIR_LIST} FROM rev_matches"),
    "review_rejects": with_(*review_parts(), body=f"SELECT {PAIR_LIST} FROM rev_rejects"),
    "feed_matches_upc": with_(PRS, *feed_parts("upc"), body=f"SELECT {PAIR_LIST} FROM feed_upc"),
    "feed_matches_exact_desc": with_(PRS, *feed_parts("exact_desc"), body=(
        f"SELECT {PAIR_LIST} FROM feed_exact_desc")),
    "feed_matches_transitive": with_(PRS, *feed_parts("transitive", "sku"), body=(
        f"SELECT {PAIR_LIST} FROM feed_transitive")),
    "build_warehouse": warehouse_sql(),
    "warehouse_from_sources": warehouse_sql(),
    "warehouse_sku_first": warehouse_sql(prefer="sku"),
    "warehouse_prefer_by_segment": warehouse_sql(prefer="segment = 'pets'"),
    "warehouse_of_domains": warehouse_sql(domains="domain IN ('pets', 'toys')"),
    "warehouse_of_whole_pairs": warehouse_sql(
        raw_pairs="uuid_a IS NOT NULL AND uuid_b IS NOT NULL"),
    "warehouse_of_all_workflows": warehouse_sql(workflows="workflow NOT IN ('none')"),
    "warehouse_without_bare": warehouse_sql(where=f"NOT {BARE}"),
    "bare_pairs": bare_pairs_sql(),
    "warehouse_pruned": warehouse_sql(prune=True, alias_rejects=True),
    "warehouse_undirected": warehouse_sql(undirected=True),
}
