"""The same questions in SQL, for an engine that shares no code with Spark."""

from __future__ import annotations

from gaugewell.checks import inputs as I
from gaugewell.checks.registry import DETECTOR_KEYS, DIGITS
from gaugewell.functions import detectors as D
from gaugewell.functions import vocab as V


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _cycle(values: tuple, number: str) -> str:
    return f"([{', '.join(_text(v) for v in values)}])[{number} % {len(values)} + 1]"


# --- inputs ----------------------------------------------------------------

MIXED = """
SELECT o_orderkey AS id, concat('Customer ', o_custkey % 97) AS name,
  CASE o_orderkey % 6 WHEN 0 THEN NULL
    WHEN 1 THEN o_custkey::varchar
    WHEN 2 THEN concat(o_custkey % 50, '.7')
    WHEN 3 THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN 4 THEN o_orderpriority
    ELSE '3000000000' END AS mixed,
  o_totalprice AS amount
FROM orders"""
MIXED_COLUMNS = (("id", "int"), ("name", "string"), ("mixed", "string"), ("amount", "double"))

LINEITEM_COLUMNS = (
    ("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp"),
)

REQUESTS = f"""
SELECT o_orderkey AS request_id, {_cycle(I.BOROUGH_CYCLE, 'o_custkey')} AS borough,
  o_orderpriority AS complaint_type, concat('AGENCY_', o_custkey % 12) AS agency_name,
  concat(strftime(o_orderdate, '%m/%d/%Y'), ' 10:00:00 AM') AS created_date,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat(strftime(
    o_orderdate::date + (o_orderkey % 30)::int, '%m/%d/%Y'), ' 10:00:00 AM') END AS closed_date,
  {_cycle(I.CHANNEL_CYCLE, 'o_orderkey')} AS channel
FROM orders"""

LITERAL_CELLS = (
    f"SELECT 'literal' AS column_name, {_cycle(I.LITERALS + (None,), 'c_custkey')} AS value FROM customer"
)
DETECTOR_CELLS = f"""{LITERAL_CELLS}
UNION ALL SELECT 'url', url FROM pages
UNION ALL SELECT 'html', html FROM pages
UNION ALL SELECT 'document', text FROM documents
UNION ALL SELECT 'message', text FROM conversations
UNION ALL SELECT 'part_name', p_name FROM part"""

RULE_CELLS = f"""
SELECT {_cycle(I.RULE_NAMES, 'c_custkey')} AS column_name,
  CASE WHEN c_custkey % 5 > 0 THEN c_name END AS value FROM customer"""

LISTING = """
SELECT concat('/data/', source, '/d', doc_id, '.tsv', CASE WHEN doc_id % 5 = 0 THEN '' ELSE '.gz' END) AS path,
  n_chars AS length FROM documents"""
DISPLAY_NAMES = """
SELECT concat('d', doc_id) AS id, concat(lang, ' ', source) AS name FROM documents WHERE doc_id % 7 > 0
UNION ALL SELECT concat('d', doc_id), source FROM documents WHERE doc_id % 7 > 0 AND doc_id % 3 = 0"""


# --- generic profile -------------------------------------------------------


def _as_int(x: str, kind: str) -> str:
    return {
        "string": rf"try_cast(regexp_extract(trim({x}), '^([+-]?\d+)(\.\d*)?$', 1) AS int)",
        "int": f"try_cast({x} AS int)",
        "double": f"try_cast(trunc({x}) AS int)",
        "timestamp": f"try_cast(floor(epoch({x})) AS int)",
    }[kind]


def _as_real(x: str, kind: str) -> str:
    return {
        "string": f"try_cast({x} AS double)",
        "int": f"{x}::double",
        "double": x,
        "timestamp": f"epoch({x})::double",
    }[kind]


def _as_date(x: str, kind: str = "string") -> str:
    if kind != "string":
        return "NULL::date"
    return rf"try_strptime(regexp_extract(trim({x}), '^(\d{{1,2}}/\d{{1,2}}/\d{{4}})', 1), '%m/%d/%Y')::date"


def _scalar(relation: str, columns, metrics: str) -> str:
    """One SELECT per column over readings i, r, d and the cell x (text cell s)."""
    parts = []
    for name, kind in columns:
        text = f"{name}" if kind == "string" else "NULL::varchar"
        parts.append(
            f"""SELECT '{name}' AS column_name, {metrics} FROM (
  SELECT "{name}" AS x, {text} AS s, {_as_int(name, kind)} AS i, {_as_real(name, kind)} AS r,
    {_as_date(name, kind)} AS d FROM ({relation}))"""
        )
    return "\nUNION ALL ".join(parts)


FILL = "count(x) AS number_non_empty_cells, count(*) FILTER (WHERE x IS NULL) AS number_empty_cells"


def _numeric(column: str, prefix: str) -> str:
    return (
        f"nullif(count({column}), 0) AS {prefix}_count, max({column}) AS {prefix}_max_value, "
        f"min({column}) AS {prefix}_min_value, round(avg({column}), {DIGITS}) AS {prefix}_mean, "
        f"round(stddev_samp({column}), {DIGITS}) AS {prefix}_stddev"
    )


INTEGER = _numeric("i", "integer")
REAL = (
    f"nullif(count(r), 0) AS real_count, round(max(r), {DIGITS}) AS real_max_value, "
    f"round(min(r), {DIGITS}) AS real_min_value, round(avg(r), {DIGITS}) AS real_mean, "
    f"round(stddev_samp(r), {DIGITS}) AS real_stddev"
)
DATE = "nullif(count(d), 0) AS date_count, max(d) AS date_max_value, min(d) AS date_min_value"
TEXT = f"count(s) AS string_count, round(avg(length(s)), {DIGITS}) AS string_average_length"


def _ranking(relation: str, name: str, order: str, k: int = 5) -> str:
    return (
        f"SELECT '{name}' AS column_name, row_number() OVER (ORDER BY {order}) AS rank, value, n FROM ("
        f'SELECT "{name}"::varchar AS value, count(*) AS n FROM ({relation}) '
        f'WHERE "{name}" IS NOT NULL GROUP BY "{name}") QUALIFY rank <= {k}'
    )


# Values that agree in their first 64 characters go by length and digest.
BY_VALUE = "left(value, 64), length(value), md5(value)"
FREQUENT_ORDER = f"n DESC, {BY_VALUE}"
SHORTEST_ORDER = f"length(value), {BY_VALUE}"
LONGEST_ORDER = f"length(value) DESC, {BY_VALUE}"


def _rankings(relation: str, columns, order: str, text_only: bool) -> str:
    return "\nUNION ALL ".join(
        f"({_ranking(relation, name, order)})" for name, kind in columns if kind == "string" or not text_only
    )


def _list(relation: str, name: str, order: str) -> str:
    return f"(SELECT string_agg(value, '|' ORDER BY rank) FROM ({_ranking(relation, name, order)}))"


def _profile(relation: str, columns, shown: dict[str, str] | None = None, lead: str = "") -> str:
    parts = []
    for name, kind in columns:
        label = (shown or {}).get(name, name)
        scalar = _scalar(relation, [(name, kind)], ", ".join((FILL, INTEGER, REAL, DATE, TEXT)))
        sections = [
            ("INTEGER (LONG)", "integer_count", "integer_max_value::varchar", "integer_min_value::varchar",
             "NULL", "NULL", "integer_mean", "integer_stddev", None),
            ("REAL", "real_count", "NULL", "NULL", "real_max_value", "real_min_value", "real_mean",
             "real_stddev", None),
            ("DATE/TIME", "date_count", "date_max_value::varchar", "date_min_value::varchar", "NULL", "NULL",
             "NULL", "NULL", None),
        ]
        if kind == "string":
            sections.append(
                ("TEXT", "string_count", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "string_average_length")
            )
        for kind_label, count, hi, lo, real_hi, real_lo, mean, dev, average in sections:
            lists = "NULL::varchar AS shortest_values, NULL::varchar AS longest_values"
            if average:
                lists = (
                    f"{_list(relation, name, SHORTEST_ORDER)} AS shortest_values, "
                    f"{_list(relation, name, LONGEST_ORDER)} AS longest_values"
                )
            parts.append(
                f"""SELECT {lead}'{label}' AS column_name, number_non_empty_cells, number_empty_cells,
  (SELECT count(DISTINCT "{name}") FROM ({relation})) AS number_distinct_values,
  {_list(relation, name, FREQUENT_ORDER)} AS frequent_values,
  '{kind_label}' AS type, {count} AS count, {hi}::varchar AS max_value, {real_hi}::double AS real_max_value,
  {lo}::varchar AS min_value, {real_lo}::double AS real_min_value, {mean}::double AS mean,
  {dev}::double AS stddev, {lists}, {average or 'NULL'}::double AS average_length
FROM ({scalar}) WHERE {count} IS NOT NULL"""
            )
    return "\nUNION ALL ".join(parts)


CUSTOMER_COLUMNS = (
    ("c_custkey", "int"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
    ("c_mktsegment", "string"),
)
PART_COLUMNS = (
    ("p_partkey", "int"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
    ("p_size", "int"), ("p_retailprice", "double"),
)
DATASETS = {
    "mixed": (MIXED, MIXED_COLUMNS),
    "customer": ("SELECT * FROM customer", CUSTOMER_COLUMNS),
    "empty": ("SELECT * FROM customer WHERE false", CUSTOMER_COLUMNS),
    "part": ("SELECT * FROM part", PART_COLUMNS),
}


def _union_profiles(*datasets: str) -> str:
    return "\nUNION ALL ".join(_profile(*DATASETS[d], lead=f"'{d}' AS dataset_id, ") for d in datasets)


def _ranked_documents() -> str:
    orders = {"frequent": FREQUENT_ORDER, "shortest": SHORTEST_ORDER, "longest": LONGEST_ORDER}
    kinds = {"doc_id": "int", "text": "string", "lang": "string", "source": "string", "n_chars": "int"}
    return "\nUNION ALL ".join(
        f"SELECT column_name, '{ranking}' AS ranking, rank, md5(value) AS digest, length(value) AS chars, n "
        f"FROM ({_ranking('SELECT * FROM documents', name, order)})"
        for name, kind in kinds.items()
        for ranking, order in orders.items()
        if kind == "string" or ranking == "frequent"
    )


def _native_dates() -> str:
    columns = {"lineitem": "l_shipdate", "orders": "o_orderdate"}
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS dataset_id, '{c}' AS column_name, count({c}) AS date_count, "
        f"max({c}::date) AS date_max_value, min({c}::date) AS date_min_value FROM {table}"
        for table, c in columns.items()
    )


# --- detectors -------------------------------------------------------------

# The look-ahead of the website pattern in two steps: hosts led by www are
# searched first, then masked for the search of the others.
WEBSITE_WWW = (
    r"^https?://www\.[a-z0-9][a-z0-9-]+[a-z0-9]\.\S{2,}|www\.[a-z0-9][a-z0-9-]+[a-z0-9]\.\S{2,}"
    r"|https?://www\.[a-z0-9]+\.\S{2,}|www\.[a-z0-9]+\.\S{2,}$"
)
WEBSITE_OTHER = r"^https?://[a-z0-9][a-z0-9-]+[a-z0-9]\.\S{2,}|https?://[a-z0-9]+\.\S{2,}"
ADDRESS_PATTERN = r"\d+[ ](?:[A-Za-z0-9.-]+[ ]?)+(?:ave|dr|rd|blvd|ln|st|av)\.?"


def _matches(cell: str, pattern: str) -> str:
    return f"regexp_matches({cell}, {_text(pattern)})"


def _any_word(words) -> str:
    return _matches("lower(value)", "|".join(words))


def _in(cell: str, names) -> str:
    return f"{cell} IN ({', '.join(_text(n) for n in names)})"


PREDICATES = {
    "zip_code": _matches("lower(value)", D.ZIP_CODE),
    "phone_number": _matches("lower(value)", D.PHONE_NUMBER),
    "school_name": _any_word(V.SCHOOL_NAME_WORDS),
    "street_name": _any_word(V.STREET_NAME_WORDS),
    "lat_lon_cord": _matches("lower(value)", D.LAT_LON_CORD),
    "college_name": _any_word(V.COLLEGE_NAME_WORDS),
    "borough": _matches("lower(value)", D.BOROUGH),
    "park_playground": _any_word(V.PARK_WORDS),
    "website": f"({_matches('lower(value)', WEBSITE_WWW)} OR "
    + _matches("regexp_replace(lower(value), 'https?://www', '~~', 'g')", WEBSITE_OTHER)
    + ")",
    "business_name": _any_word(V.BUSINESS_NAME_WORDS),
    "subject_in_school": _in("lower(value)", V.SUBJECTS),
    "neighbourhood": "lower(value) IN (SELECT lower(n_name) FROM nation UNION ALL SELECT lower(p_name) FROM part "
    f"UNION ALL SELECT unnest([{', '.join(_text(n) for n in I.NEIGHBOURHOODS)}]))",
    "city_agency": _any_word(V.CITY_AGENCY_WORDS),
    "school_level": _any_word(V.SCHOOL_LEVEL_WORDS),
    "building_classification": _matches("value", D.BUILDING_CLASSIFICATION),
    "area_of_study": _in("lower(value)", V.AREAS_OF_STUDY),
    "MiddleInitial": _matches("value", D.MIDDLE_INITIAL),
    "car_make": _in("value", V.CAR_MAKES),
    "location_type": _in("value", V.LOCATION_TYPES),
    "color": _in("value", V.COLORS),
    "Latitude": _matches("lower(value)", D.LATITUDE),
    "Longitude": _matches("lower(value)", D.LONGITUDE),
    "address": _matches("lower(value)", ADDRESS_PATTERN),
}
OPT_IN = ("Latitude", "Longitude", "address")
STANDARD = [n for n in PREDICATES if n not in OPT_IN]
NON_EMPTY = "number_of_non_empty_cells"


def _hits(predicate: str) -> str:
    return f"count(*) FILTER (WHERE {predicate})"


def _detector(name: str) -> str:
    return f"SELECT column_name, {_hits(PREDICATES[name])} AS n FROM ({DETECTOR_CELLS}) GROUP BY column_name"


def _long_counts(cells: str, predicates: dict[str, str], key: str = "column_name") -> str:
    wide = ", ".join(f'{_hits(p)} AS "{n}"' for n, p in predicates.items())
    lead = f"{wide}, " if wide else ""
    labels = [*predicates, NON_EMPTY]
    listed = ", ".join(f"""{{'label': '{n}', 'count': "{n}"}}""" for n in labels)
    return (
        f"SELECT {key}, e.label AS label, e.count AS count, e.pos AS pos FROM ("
        f"SELECT {key}, unnest(list_transform([{listed}], lambda x, i: "
        f"{{'label': x.label, 'count': x.count, 'pos': i}})) AS e FROM ("
        f"SELECT {key}, {lead}count(value) AS {NON_EMPTY} FROM ({cells}) GROUP BY {key}))"
    )


def _standard() -> dict[str, str]:
    return {n: PREDICATES[n] for n in STANDARD}


KEYED_CELLS = f"""
SELECT 'literal' AS column_name, concat('literal ', c_custkey) AS row_key,
  {_cycle(I.LITERALS + (None,), 'c_custkey')} AS value FROM customer
UNION ALL SELECT 'url', concat('url ', page_id), url FROM pages
UNION ALL SELECT 'html', concat('html ', page_id), html FROM pages
UNION ALL SELECT 'document', concat('document ', doc_id), text FROM documents
UNION ALL SELECT 'message', concat('message ', conv_id, ' ', turn), text FROM conversations
UNION ALL SELECT 'part_name', concat('part_name ', p_partkey), p_name FROM part"""

SAMPLE = f"""
SELECT column_name, value FROM ({KEYED_CELLS})
WHERE ('0x' || substr(md5(row_key), 1, 8))::bigint % 10000 < 1000"""


def _types(counts: str, key: str = "column_name", name: str = "column_name") -> str:
    """Hits in any column, types its name implies, else ``other``."""
    tokens = f"string_split(lower({name}), '_')"
    rules = {
        "person_name": [("last", "name"), ("first", "name")],
        "vehicle_body_type": [("vehicle", "body", "type")],
        "vehicle_type_code": [("vehicle", "type", "code")],
    }
    lead = "column_name" if key == "column_name" else f"{key}, {name} AS column_name"
    base = f"SELECT * FROM ({counts})"
    by_name = "\nUNION ALL ".join(
        f"SELECT {key}, '{kind}' AS semantic_type, NULL::varchar AS label, count FROM c WHERE label = '{NON_EMPTY}' AND ("
        + " OR ".join(f"list_has_all({tokens}, [{', '.join(_text(w) for w in words)}])" for words in options)
        + ")"
        for kind, options in rules.items()
    )
    return f"""WITH c AS ({base}), found AS (
SELECT {key}, label AS semantic_type, NULL::varchar AS label, count FROM c WHERE label <> '{NON_EMPTY}' AND count > 0
UNION ALL {by_name})
SELECT {lead}, semantic_type, label, count FROM found
UNION ALL SELECT {lead}, 'other', {name}, count FROM c
WHERE label = '{NON_EMPTY}' AND {key} NOT IN (SELECT {key} FROM found)"""


def _table_cells() -> str:
    parts = []
    for name, kind in LINEITEM_COLUMNS:
        parts.append(f"SELECT '{name}' AS column_name, {name}::varchar AS value FROM lineitem")
    return " UNION ALL ".join(parts)


FILE_CELLS = f"SELECT concat('d1.', column_name, '.1.2') AS file_name, column_name, value FROM ({DETECTOR_CELLS})"

# Cells as their files' types print them; where one cell is no number all stay as written.
NUMBER_CELLS = """
SELECT 'd1.padded.1.2' AS file_name, o_orderkey::varchar AS value FROM orders
UNION ALL SELECT 'd1.large.1.2', (3000000000 + o_orderkey)::varchar FROM orders
UNION ALL SELECT 'd1.mixed.1.2', ['7.0', '40.71', '12.0', NULL][o_orderkey % 4 + 1] FROM orders
UNION ALL SELECT 'd1.flag.1.2', CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END FROM orders
UNION ALL SELECT 'd1.day.1.2', o_orderdate::date::varchar FROM orders
UNION ALL SELECT 'd1.almost.1.2', CASE WHEN o_orderkey % 97 = 1 THEN 'none' ELSE concat('0', o_custkey) END FROM orders"""


def _fixed_vocabulary() -> str:
    predicates = {
        "area_of_study": _in("lower(value)", V.AREAS_OF_STUDY + V.FIXED_AREAS_OF_STUDY),
        "location_type": _in("value", V.LOCATION_TYPES + V.FIXED_LOCATION_TYPES),
    }
    return f"SELECT column_name, label, count FROM ({_long_counts(DETECTOR_CELLS, predicates)})"


# --- reports ---------------------------------------------------------------

FIVE = "('MANHATTAN', 'BROOKLYN', 'BRONX', 'QUEENS', 'STATEN ISLAND')"


def _top(what: str, k: int) -> str:
    return f"""SELECT borough, {what}, count(*) AS n,
  row_number() OVER (PARTITION BY borough ORDER BY count(*) DESC, {what}) AS rank
FROM ({REQUESTS}) WHERE borough IN {FIVE} GROUP BY borough, {what} QUALIFY rank <= {k}"""


def _daily(where: str = "true") -> str:
    return f"SELECT {_as_date('created_date')} AS day, count(*) AS n FROM ({REQUESTS}) WHERE {where} GROUP BY 1"


def oracle_sql() -> dict[str, str]:
    first = (
        "SELECT row_number() OVER (ORDER BY length, path) AS ordinal, path, length, "
        "split_part(split_part(path, '/', -1), '.', 1) AS dataset_id "
        f"FROM ({LISTING}) WHERE path LIKE '%.gz' QUALIFY ordinal <= 300"
    )
    return {
        "gp_non_empty": _scalar(MIXED, MIXED_COLUMNS, "count(x) AS number_non_empty_cells"),
        "gp_empty": _scalar(MIXED, MIXED_COLUMNS, "count(*) FILTER (WHERE x IS NULL) AS number_empty_cells"),
        "gp_distinct_exact": _scalar(
            "SELECT * FROM lineitem", LINEITEM_COLUMNS, "count(DISTINCT x) AS number_distinct_values"
        ),
        "gp_distinct_approx": _scalar(
            "SELECT * FROM lineitem", LINEITEM_COLUMNS, "count(DISTINCT x) AS exact, true AS within_three_errors"
        ),
        "gp_frequent_values": _rankings(MIXED, MIXED_COLUMNS, FREQUENT_ORDER, False),
        "gp_shortest_values": _rankings(MIXED, MIXED_COLUMNS, SHORTEST_ORDER, True),
        "gp_longest_values": _rankings(MIXED, MIXED_COLUMNS, LONGEST_ORDER, True),
        "gp_ranked_documents": _ranked_documents(),
        "gp_integer_stats": _scalar(MIXED, MIXED_COLUMNS, INTEGER),
        "gp_real_stats": _scalar(MIXED, MIXED_COLUMNS, REAL),
        "gp_date_stats": _scalar(MIXED, MIXED_COLUMNS, DATE),
        "gp_text_stats": _scalar(MIXED, [c for c in MIXED_COLUMNS if c[1] == "string"], TEXT),
        "gp_text_only_strings": _scalar(
            "SELECT * FROM orders", (("o_orderstatus", "string"), ("o_orderpriority", "string")), TEXT
        ),
        "gp_scalar_all": _scalar(
            "SELECT * FROM lineitem", LINEITEM_COLUMNS, ", ".join((FILL, INTEGER, REAL, DATE, TEXT))
        ),
        "gp_dotted_column": _profile(MIXED, MIXED_COLUMNS, {"name": "na.me"}),
        "gp_profile": _profile(MIXED, MIXED_COLUMNS),
        "gp_profile_lineitem": _profile("SELECT * FROM lineitem", LINEITEM_COLUMNS),
        "gp_native_dates": _native_dates(),
        "so_union_profiles": _union_profiles("mixed", "customer", "empty", "part"),
        "src_tsv_header": REQUESTS,
        "src_tsv_headerless": "SELECT concat('p', p_partkey) AS id, p_name AS name FROM part",
        "src_column_files": FILE_CELLS,
        "src_column_files_inferred": NUMBER_CELLS,
        "src_staged_tables": _union_profiles("mixed", "customer", "part"),
        "src_file_listing": "SELECT o_orderstatus AS status, "
        "sum(strlen(concat_ws(',', o_orderkey, o_orderpriority)) + 1)::bigint AS bytes FROM orders GROUP BY 1",
        "src_manifest": """SELECT row_number() OVER (ORDER BY name) - 1 AS pos, name AS file_name,
  CASE WHEN p_size > 1 THEN concat('ds', p_size) END AS dataset_id,
  CASE WHEN p_size > 1 THEN brand END AS column_name, p_size > 1 AS valid
FROM (SELECT DISTINCT p_size, replace(p_brand, '#', '_') AS brand,
  concat_ws('.', concat('ds', p_size), replace(p_brand, '#', '_'), '1', CASE WHEN p_size > 1 THEN '2' END) AS name
  FROM part)""",
        "snk_profile_json": _profile(MIXED, MIXED_COLUMNS, lead="'orders' AS dataset_name, "),
        "snk_profiles_written_twice": _union_profiles("customer", "part"),
        "snk_semantic_json": _types(_long_counts(RULE_CELLS, _standard())),
        "snk_csv": f"SELECT borough, complaint_type, n FROM ({_top('complaint_type', 3)})",
        "snk_csv_single": _daily(),
        "cat_first_n": first,
        "cat_exclude": f"SELECT dataset_id, ordinal FROM ({first}) WHERE dataset_id NOT IN "
        "(SELECT concat('d', doc_id) FROM labels WHERE toxic = 1)",
        "cat_name_lookup": f"""SELECT f.dataset_id, f.length, n.name AS dataset_name
FROM (SELECT split_part(split_part(path, '/', -1), '.', 1) AS dataset_id, length FROM ({LISTING})) f
LEFT JOIN (SELECT id, min(name) AS name FROM ({DISPLAY_NAMES}) GROUP BY id) n ON n.id = f.dataset_id""",
        **{key: _detector(name) for key, name in DETECTOR_KEYS.items()},
        "sd_non_empty": f"SELECT column_name, count(value) AS n FROM ({DETECTOR_CELLS}) GROUP BY column_name",
        "sd_fixed_vocabulary": _fixed_vocabulary(),
        "sw_sample": f"SELECT column_name, md5(value) AS digest FROM ({SAMPLE})",
        "sw_candidates": "SELECT column_name, label, count FROM "
        f"({_long_counts(SAMPLE, _standard())}) WHERE count > 0",
        "sw_full_counts": f"SELECT column_name, label, count FROM ({_long_counts(DETECTOR_CELLS, _standard())})",
        "sw_name_rules": "SELECT column_name, semantic_type, count FROM "
        f"({_types(_long_counts(RULE_CELLS, {}))}) WHERE semantic_type <> 'other'",
        "sw_other": f"SELECT * FROM ({_types(_long_counts(RULE_CELLS, {}))}) WHERE semantic_type = 'other'",
        "sw_profile": _types(_long_counts(DETECTOR_CELLS, _standard())),
        "sw_profile_table": _types(_long_counts(_table_cells(), PREDICATES)),
        "sw_profile_files": _types(
            _long_counts(FILE_CELLS, _standard(), "file_name"), "file_name", "split_part(file_name, '.', 2)"
        ),
        "rq_top3_complaints": _top("complaint_type", 3),
        "rq_top_agency": _top("agency_name", 1),
        "rq_daily": _daily(),
        "rq_daily_mobile": _daily("channel = 'MOBILE'"),
        "rq_avg_close_days": f"""SELECT agency_name,
  round(avg(date_diff('day', {_as_date('created_date')}, {_as_date('closed_date')})), {DIGITS}) AS avg_days
FROM ({REQUESTS}) GROUP BY agency_name""",
        "rq_complaints_over_time": f"SELECT {_as_date('closed_date')} AS day, complaint_type, borough FROM ({REQUESTS})",
        "rq_borough_totals": f"SELECT borough, count(*) AS n FROM ({REQUESTS}) WHERE borough IN {FIVE} GROUP BY borough",
    }
