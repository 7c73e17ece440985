"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, hashing, text
from .inputs import DOB, MOVED_DAY, ORDER_DAY, compact_date, us_date
from .registry import Tables, expressions, query

AS_OF = "2024-06-30"

expressions(
    "fn_trim",
    "part",
    ["p_partkey"],
    [
        "CASE WHEN p_partkey % 3 = 0 THEN '  ' || p_name || ' (CE) ' WHEN p_partkey % 3 = 1 THEN upper(p_name) || ' ADVANCE (CE)' ELSE p_name || ' ' END AS x"
    ],
    lambda: {
        "trimmed": F.trim("x"),
        "without_suffix": text.strip_suffix("x", "(CE)"),
        "without_chars": text.strip_suffix("x", "(CE)", mode="charset"),
    },
    {
        "trimmed": "trim(x)",
        "without_suffix": r"regexp_replace(trim(x), '\s*\(CE\)$', '')",
        "without_chars": "rtrim(trim(x), ' (CE)')",
    },
)
expressions(
    "fn_case",
    "customer",
    ["c_custkey"],
    ["c_name", "c_mktsegment"],
    lambda: {"upper_name": F.upper("c_name"), "lower_segment": F.lower("c_mktsegment")},
    {"upper_name": "upper(c_name)", "lower_segment": "lower(c_mktsegment)"},
)
expressions(
    "fn_concat",
    "customer",
    ["c_custkey"],
    ["c_name AS street", "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS city"],
    lambda: {"address": text.join_address("street", "city", F.lit("WA"))},
    {"address": "street || ', ' || city || ', ' || 'WA'"},
)
expressions(
    "fn_concat_ws",
    "customer",
    ["c_custkey"],
    ["c_name AS a", "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS b"],
    lambda: {"joined": F.concat_ws(";", "a", "b"), "plain": F.concat_ws("", "b", "a")},
    {"joined": "concat_ws(';', a, b)", "plain": "concat_ws('', b, a)"},
)
expressions(
    "fn_substring",
    "orders",
    ["o_orderkey"],
    ["o_orderpriority AS x"],
    lambda: {
        "first_two": F.substring(F.upper("x"), 1, 2),
        "from_third": F.expr("substring(x, 3, length(x))"),
        "last_four": F.right("x", F.lit(4)),
        "without_last_four": F.expr("substr(x, 1, length(x) - 4)"),
    },
    {
        "first_two": "substring(upper(x), 1, 2)",
        "from_third": "substring(x, 3, length(x))",
        "last_four": "right(x, 4)",
        "without_last_four": "left(x, length(x) - 4)",
    },
)
expressions(
    "fn_substring_index",
    "part",
    ["p_partkey"],
    ["CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE p_name || ' (' || p_brand || ') (x)' END AS x"],
    lambda: {"before_paren": F.substring_index("x", "(", 1)},
    {"before_paren": "split_part(x, '(', 1)"},
)
expressions(
    "fn_pad",
    "orders",
    ["o_orderkey"],
    ["CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 123456 AS STRING) END AS x"],
    lambda: {"four": text.pad_id("x", 4), "nine": text.pad_id("x", 9)},
    {
        "four": "CASE WHEN length(x) < 4 THEN lpad(x, 4, '0') ELSE x END",
        "nine": "lpad(x, 9, '0')",
    },
)
expressions(
    "fn_length",
    "documents",
    ["doc_id"],
    ["text"],
    lambda: {
        "n": F.length("text").cast("bigint"),
        "is_short": F.length("text") < 200,
        "is_long": F.length("text") > 2000,
    },
    {"n": "length(text)", "is_short": "length(text) < 200", "is_long": "length(text) > 2000"},
)
expressions(
    "fn_translate",
    "documents",
    ["doc_id"],
    ["text"],
    lambda: {
        "clean_md5": F.md5(F.translate("text", ".\r\n", "")),
        "n_left": F.length(F.translate("text", ".\r\n", "")).cast("bigint"),
    },
    {
        "clean_md5": "md5(translate(text, '.' || chr(13) || chr(10), ''))",
        "n_left": "length(translate(text, '.' || chr(13) || chr(10), ''))",
    },
)
expressions(
    "fn_regexp_extract",
    "orders",
    ["o_orderkey"],
    [f"'feed-' || CAST({ORDER_DAY} AS STRING) || CASE WHEN o_orderkey % 3 = 0 THEN '.txt' ELSE '.csv' END AS x"],
    lambda: {"day": F.regexp_extract("x", r"(feed-)(\d\d\d\d-\d\d-\d\d)(\.csv)", 2)},
    {"day": r"regexp_extract(x, '(feed-)(\d\d\d\d-\d\d-\d\d)(\.csv)', 2)"},
)
expressions(
    "fn_regexp_replace",
    "documents",
    ["doc_id"],
    ["text"],
    lambda: {
        "only_digits": F.md5(text.digits("text")),
        "one_line": F.md5(F.regexp_replace("text", r"[\r\n]", "")),
        "apostrophes": F.md5(F.regexp_replace("text", "'", "’")),
    },
    {
        "only_digits": "md5(regexp_replace(text, '[^0-9]', '', 'g'))",
        "one_line": r"md5(regexp_replace(text, '[\r\n]', '', 'g'))",
        "apostrophes": "md5(replace(text, '''', '’'))",
    },
)
expressions(
    "fn_rlike",
    "orders",
    ["o_orderkey"],
    [
        "CASE o_orderkey % 5 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN 'x' || o_custkey WHEN 2 THEN 'CE' || o_custkey "
        "WHEN 3 THEN 'a.b-c' || o_custkey || '@mail.example.org' ELSE '(206) 555-1234' END AS x"
    ],
    lambda: {
        "is_number": F.col("x").rlike("^[0-9]+$"),
        "is_email": text.email_ok("x"),
        "is_phone": text.phone_ok("x"),
        "is_course": F.col("x").rlike("CE+[0-9]"),
    },
    {
        "is_number": "regexp_matches(x, '^[0-9]+$')",
        "is_email": r"regexp_matches(x, '^\w+([.-]?\w+)*@\w+([.-]?\w+)*(\.\w{2,3})+$')",
        "is_phone": r"regexp_matches(x, '^(?:\+?(\d{1})?-?\(?(\d{3})\)?[\s.-]?)?(\d{3})[\s.-]?(\d{4})[\s.-]?')",
        "is_course": "regexp_matches(x, 'CE+[0-9]')",
    },
)
expressions(
    "fn_like",
    "documents",
    ["doc_id"],
    ["text", "source"],
    lambda: {
        "has_paren": F.col("text").like("%(%)%"),
        "has_break": F.col("text").like("%\n%"),
        "is_blank": F.col("source").like(""),
    },
    {
        "has_paren": "text LIKE '%(%)%'",
        "has_break": "text LIKE '%' || chr(10) || '%'",
        "is_blank": "source LIKE ''",
    },
)
expressions(
    "fn_split",
    "supplier",
    ["s_suppkey"],
    ["'I' || s_suppkey || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '   Ann  Lee' END AS x", "'sheet-2024' || s_suppkey AS y"],
    lambda: {
        "code": text.word("x", 0),
        "name": F.concat(text.word("x", 1), F.lit(" "), text.word("x", 2)),
        "sheet": F.try_element_at(F.split("y", "-"), F.lit(2)),
        "none": F.try_element_at(F.split("y", "-"), F.lit(3)),
    },
    {
        "code": r"regexp_split_to_array(x, '\s+')[1]",
        "name": r"regexp_split_to_array(x, '\s+')[2] || ' ' || regexp_split_to_array(x, '\s+')[3]",
        "sheet": "string_split(y, '-')[2]",
        "none": "string_split(y, '-')[3]",
    },
)
expressions(
    "fn_md5",
    "customer",
    ["c_custkey"],
    ["c_name AS a", "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS b", "c_nationkey AS n"],
    lambda: {
        "safe_hash": hashing.row_hash("a", "b", "n"),
        "plain_hash": hashing.row_hash("a", "b", "n", mode="plain"),
    },
    {
        "safe_hash": "md5(a || chr(31) || coalesce(b, chr(0)) || chr(31) || CAST(n AS STRING))",
        "plain_hash": "md5(concat_ws('', a, b, CAST(n AS STRING)))",
    },
)
expressions(
    "fn_parse_date_one",
    "orders",
    ["o_orderkey"],
    [
        f"CASE WHEN o_orderkey % 7 = 0 THEN '13/45/2020' WHEN o_orderkey % 11 = 0 THEN '' ELSE {us_date(ORDER_DAY)} END AS us",
        f"{compact_date(ORDER_DAY)} AS compact",
        f"{compact_date(ORDER_DAY)} || '101500' AS stamp",
    ],
    lambda: {
        "us_day": dates.parse_date("us", "MM/dd/yyyy"),
        "compact_day": dates.parse_date("compact", "yyyyMMdd"),
        "stamp_text": F.date_format(dates.parse_ts("stamp", "yyyyMMddHHmmss"), "yyyy-MM-dd HH:mm:ss"),
    },
    {
        "us_day": "CAST(try_strptime(us, '%m/%d/%Y') AS DATE)",
        "compact_day": "CAST(try_strptime(compact, '%Y%m%d') AS DATE)",
        "stamp_text": "strftime(try_strptime(stamp, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S')",
    },
)

_MIXED = (
    f"CASE o_orderkey % 6 WHEN 0 THEN {us_date(ORDER_DAY)} WHEN 1 THEN replace({us_date(ORDER_DAY)}, '/', '-') "
    f"WHEN 2 THEN replace({us_date(ORDER_DAY)}, '/', '') WHEN 3 THEN CAST({ORDER_DAY} AS STRING) "
    f"WHEN 4 THEN substr({us_date(ORDER_DAY)}, 1, 6) || substr({us_date(ORDER_DAY)}, 9, 2) ELSE 'soon' END AS x"
)
expressions(
    "fn_parse_date_multi",
    "orders",
    ["o_orderkey"],
    [_MIXED],
    lambda: {
        "day": dates.parse_date("x", "MM/dd/yy", "MM/dd/yyyy", "MM-dd-yyyy", "MMddyyyy", as_of=AS_OF),
        "day_iso": dates.parse_date("x", "MM/dd/yyyy", "MM-dd-yyyy", "yyyy-MM-dd", "MMddyyyy"),
    },
    {
        "day": r"CASE WHEN regexp_matches(x, '^\d+/\d+/\d\d$') THEN CAST(try_strptime(substr(x, 1, 6) || "
        "(CASE WHEN CAST(substr(x, 7, 2) AS INT) <= 24 THEN '20' ELSE '19' END) || substr(x, 7, 2), '%m/%d/%Y') AS DATE) "
        "ELSE CAST(try_strptime(x, ['%m/%d/%Y', '%m-%d-%Y', '%m%d%Y']) AS DATE) END",
        "day_iso": r"CASE WHEN regexp_matches(x, '^\d+/\d+/\d\d$') THEN NULL ELSE "
        "CAST(try_strptime(x, ['%m/%d/%Y', '%m-%d-%Y', '%Y-%m-%d', '%m%d%Y']) AS DATE) END",
    },
)
expressions(
    "fn_parse_date_free",
    "orders",
    ["o_orderkey"],
    [
        f"CASE o_orderkey % 5 WHEN 0 THEN CAST({ORDER_DAY} AS STRING) || ' 10:20:30' WHEN 1 THEN {us_date(ORDER_DAY)} || ' 9:05' "
        f"WHEN 2 THEN {us_date(ORDER_DAY)} WHEN 3 THEN {compact_date(ORDER_DAY)} ELSE 'never' END AS x"
    ],
    lambda: {"stamp": F.date_format(dates.parse_ts_any("x"), "yyyy-MM-dd HH:mm:ss")},
    {
        "stamp": "strftime(try_strptime(x, ['%Y-%m-%d %H:%M:%S', '%m/%d/%Y %H:%M', '%m/%d/%Y', '%Y%m%d']), '%Y-%m-%d %H:%M:%S')"
    },
)
expressions(
    "fn_date_sanity",
    "orders",
    ["o_orderkey"],
    [f"CASE WHEN o_orderkey % 3 = 0 THEN {ORDER_DAY} - 40000 ELSE {ORDER_DAY} END AS d"],
    lambda: {"sane": dates.sane_date("d")},
    {"sane": "CASE WHEN year(d) > 1900 THEN d END"},
)
expressions(
    "fn_date_format",
    "orders",
    ["o_orderkey"],
    [f"{ORDER_DAY} AS d"],
    lambda: {"us": F.date_format("d", "MM/dd/yyyy"), "iso": F.date_format("d", "yyyy-MM-dd")},
    {"us": "strftime(d, '%m/%d/%Y')", "iso": "strftime(d, '%Y-%m-%d')"},
)
expressions(
    "fn_age_gate",
    "customer",
    ["c_custkey"],
    [f"CASE WHEN c_custkey % 5 = 0 THEN {DOB} - 30000 ELSE {DOB} END AS dob"],
    lambda: {"is_adult": dates.adult("dob", AS_OF)},
    {"is_adult": f"year(dob) >= 1900 AND dob <= DATE '{AS_OF}' - {dates.ADULT_DAYS}"},
)
expressions(
    "fn_current",
    "orders",
    ["o_orderkey"],
    [f"{MOVED_DAY} AS d"],
    lambda: {"is_past": F.col("d") < dates.as_of_date(AS_OF), "run_day": dates.as_of_date(AS_OF)},
    {"is_past": f"d < DATE '{AS_OF}'", "run_day": f"DATE '{AS_OF}'"},
)
expressions(
    "fn_cast",
    "orders",
    ["o_orderkey"],
    ["CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN 'n/a' WHEN 2 THEN '' ELSE o_custkey || '.25' END AS x"],
    lambda: {
        "as_double": F.col("x").try_cast("double"),
        "as_decimal": F.col("x").try_cast("decimal(9,2)"),
        "as_bigint": F.when(~F.col("x").contains("."), F.col("x").try_cast("bigint")),
        "as_date": F.col("x").try_cast("date").isNotNull() & F.col("x").contains("-"),
    },
    {
        "as_double": "try_cast(x AS DOUBLE)",
        "as_decimal": "try_cast(x AS DECIMAL(9,2))",
        "as_bigint": "CASE WHEN NOT contains(x, '.') THEN try_cast(x AS BIGINT) END",
        "as_date": "try_cast(x AS DATE) IS NOT NULL AND contains(x, '-')",
    },
)
expressions(
    "fn_coalesce",
    "customer",
    ["c_custkey"],
    ["CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS a", "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS b"],
    lambda: {"first_known": F.coalesce("a", "b"), "with_default": F.coalesce("a", "b", F.lit("none"))},
    {"first_known": "coalesce(a, b)", "with_default": "coalesce(a, b, 'none')"},
)
expressions(
    "fn_case_when",
    "lineitem",
    ["l_orderkey", "l_linenumber", "l_partkey"],
    ["l_quantity", "l_returnflag"],
    lambda: {
        "band": F.when(F.col("l_quantity") >= 40, "high").when(F.col("l_quantity") >= 20, "middle").otherwise("low"),
        "note": F.when(F.col("l_returnflag") == "R", "returned"),
    },
    {
        "band": "CASE WHEN l_quantity >= 40 THEN 'high' WHEN l_quantity >= 20 THEN 'middle' ELSE 'low' END",
        "note": "CASE WHEN l_returnflag = 'R' THEN 'returned' END",
    },
)
expressions(
    "fn_between",
    "orders",
    ["o_orderkey"],
    [f"{ORDER_DAY} AS d", "o_totalprice"],
    lambda: {
        "in_range": F.col("o_totalprice").between(1000, 200000),
        "in_year": F.col("d").between("1996-01-01", "1996-12-31"),
        "out_of_year": ~F.col("d").between("1996-01-01", "1996-12-31"),
    },
    {
        "in_range": "o_totalprice BETWEEN 1000 AND 200000",
        "in_year": "d BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'",
        "out_of_year": "d NOT BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'",
    },
)
expressions(
    "fn_bool_ops",
    "customer",
    ["c_custkey"],
    ["c_acctbal", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS s"],
    lambda: {
        "both": (F.col("c_acctbal") > 0) & (F.col("s") == "BUILDING"),
        "either": (F.col("c_acctbal") > 0) | (F.col("s") == "BUILDING"),
        "neither": ~((F.col("c_acctbal") > 0) | (F.col("s") == "BUILDING")),
    },
    {
        "both": "c_acctbal > 0 AND s = 'BUILDING'",
        "either": "c_acctbal > 0 OR s = 'BUILDING'",
        "neither": "NOT (c_acctbal > 0 OR s = 'BUILDING')",
    },
)
_PHONE = (
    "CASE c_custkey % 5 WHEN 0 THEN '555-1234' WHEN 1 THEN '+1 (206) 555-' || lpad(CAST(c_custkey % 9999 AS STRING), 4, '0') "
    "WHEN 2 THEN '206.555.' || lpad(CAST(c_custkey % 9999 AS STRING), 4, '0') WHEN 3 THEN NULL ELSE 'Ext_5 206' END AS x"
)
expressions(
    "fn_phone",
    "customer",
    ["c_custkey"],
    [_PHONE],
    lambda: {"phone": text.normalize_phone("x")},
    {
        "phone": "CASE WHEN length(right(regexp_replace(x, '[^0-9]', '', 'g'), 10)) = 10 "
        "THEN '1' || right(regexp_replace(x, '[^0-9]', '', 'g'), 10) END"
    },
)
expressions(
    "fn_phone_simple",
    "customer",
    ["c_custkey"],
    [_PHONE],
    lambda: {"phone": text.prefix_phone("x")},
    {"phone": "'1' || regexp_replace(x, '[^A-Z0-9_]', '', 'g')"},
)
expressions(
    "fn_ssn4",
    "orders",
    ["o_orderkey"],
    ["CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 1234567 AS STRING) END AS x"],
    lambda: {"padded_last4": text.last4("x"), "plain_last4": text.last4("x", pad=None), "four": text.pad_id("x", 4)},
    {
        "padded_last4": "substring(lpad(x, 9, '0'), 6, 4)",
        "plain_last4": "right(x, 4)",
        "four": "CASE WHEN length(x) < 4 THEN lpad(x, 4, '0') ELSE x END",
    },
)

# A key for checks on invented ids only; jobs pass their own.
CHECK_KEY = "0123456789abcdef"


@query("fn_encrypt", "SELECT c_custkey, CAST(c_custkey + 100000000 AS VARCHAR) AS revealed, false AS token_is_plain FROM customer")
def fn_encrypt(t: Tables):
    plain = t.customer.select("c_custkey", (F.col("c_custkey") + 100000000).cast("string").alias("ssn"))
    sealed = hashing.protect_column(plain, "ssn", CHECK_KEY, to="token")
    opened = hashing.reveal_column(sealed, "token", CHECK_KEY, to="revealed")
    return opened.select("c_custkey", "revealed", (F.col("token") == F.col("ssn")).alias("token_is_plain"))


@query(
    "fn_decrypt",
    "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey + 100000000 AS VARCHAR) END AS revealed, "
    "sha256('salt' || chr(31) || CAST(c_custkey + 100000000 AS VARCHAR)) AS print FROM customer",
)
def fn_decrypt(t: Tables):
    plain = t.customer.select("c_custkey", (F.col("c_custkey") + 100000000).cast("string").alias("ssn"))
    sealed = hashing.protect_column(plain, "ssn", CHECK_KEY, to="token")
    damaged = sealed.withColumn("token", F.when(F.col("c_custkey") % 5 == 0, F.lit("AAAA")).otherwise(F.col("token")))
    return hashing.reveal_column(damaged, "token", CHECK_KEY, to="revealed").select(
        "c_custkey", "revealed", hashing.fingerprint("ssn", "salt").alias("print")
    )


@query("fn_monotonic_id", "SELECT count(*) AS n_rows, count(*) AS n_ids FROM lineitem")
def fn_monotonic_id(t: Tables):
    # Unique ids without a shuffle; the count of distinct ids proves it.
    ids = t.lineitem.select(F.monotonically_increasing_id().alias("id"))
    return ids.groupBy("id").agg(F.count("*").alias("n")).agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_ids"))
