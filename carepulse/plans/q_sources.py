"""Source / sink queries: every file format round-trips the whole table through the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carepulse.functions.quality import column_profile, validate_domain
from carepulse.functions.records import row_to_csv
from carepulse.plans.catalog import register
from carepulse.plans.standins import (
    ENCOUNTER_STANDIN_COLUMNS, ENCOUNTERS_SQL, PREDICTIONS_SQL, encounters, predictions, table,
)
from carepulse.session import new_scratch
from carepulse.sources.files import (
    read_csv_inferred, read_first_available, read_header_dir, read_headerless_csv,
    read_positional, read_results,
)
from carepulse.sources.lookups import decode, encode_strict, lookup_frame, read_code_lookups
from carepulse.sources.writers import from_file_names, publish_json, write_csv
from carepulse.schemas import LEGACY_ADMISSION_TYPE, LEGACY_DISCHARGE, PROBABILITY_CSV_NAME

_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderpriority", T.StringType()),
])
# Result file layout as written (probability column under its file name).
_PRED_FILE_SCHEMA = T.StructType([
    T.StructField("encounter_id", T.LongType()), T.StructField("patient_nbr", T.LongType()),
    T.StructField("segment", T.StringType()), T.StructField("readmission_prediction", T.IntegerType()),
    T.StructField(PROBABILITY_CSV_NAME, T.DoubleType()),
])


@register("csv_headerless_scan", f"SELECT {', '.join(_ORDERS_COLS)} FROM orders")
def q_csv_headerless_scan(spark, sf):
    path = new_scratch(spark, "headerless")
    table(spark, sf, "orders").select(*_ORDERS_COLS).write.csv(path, header=False)
    return read_headerless_csv(spark, path, _ORDERS_SCHEMA)


@register("csv_header_dir_scan", ENCOUNTERS_SQL)
def q_csv_header_dir_scan(spark, sf):
    path = new_scratch(spark, "header_dir")
    encounters(spark, sf).write.csv(path, header=True)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ENCOUNTER_STANDIN_COLUMNS])
    return read_header_dir(spark, path, schema)


@register("csv_infer_scan", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_brand, p_size, p_retailprice FROM part
""")
def q_csv_infer_scan(spark, sf):
    path = new_scratch(spark, "infer")
    table(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice") \
        .write.csv(path, header=True)
    return read_csv_inferred(spark, path)


@register("csv_positional_rename", """
SELECT CAST(l_orderkey AS INTEGER) AS order_id, l_linenumber AS line_no, l_quantity AS qty,
       l_discount AS discount FROM lineitem
""")
def q_csv_positional_rename(spark, sf):
    path = new_scratch(spark, "positional")
    table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount") \
        .write.csv(path, header=False)
    return read_positional(spark, path, ["order_id", "line_no", "qty", "discount"])


@register("results_union_scan", """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice
FROM orders
""")
def q_results_union_scan(spark, sf):
    o = table(spark, sf, "orders")
    a, b = new_scratch(spark, "results_a"), new_scratch(spark, "results_b")
    o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderstatus") \
        .write.csv(a, header=True)
    o.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_custkey", "o_totalprice") \
        .write.csv(b, header=True)
    sa = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                       T.StructField("o_orderstatus", T.StringType())])
    sb = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                       T.StructField("o_totalprice", T.DoubleType())])
    return read_results(spark, [(a, sa), (b, sb)])


@register("fallback_scan", PREDICTIONS_SQL)
def q_fallback_scan(spark, sf):
    primary, fallback = new_scratch(spark, "primary_absent"), new_scratch(spark, "fallback")
    write_csv(predictions(spark, sf), fallback)
    return from_file_names(read_first_available(spark, [primary, fallback], _PRED_FILE_SCHEMA))


@register("append_roundtrip", PREDICTIONS_SQL)
def q_append_roundtrip(spark, sf):
    path = new_scratch(spark, "append")
    p = predictions(spark, sf)
    write_csv(p.where(F.col("readmission_prediction") == 2), path, mode="append")
    write_csv(p.where(F.col("readmission_prediction") != 2), path, mode="append")
    return from_file_names(read_results(spark, [path], _PRED_FILE_SCHEMA))


@register("batch_score_overwrite", PREDICTIONS_SQL)
def q_batch_score_overwrite(spark, sf):
    path = new_scratch(spark, "overwrite")
    p = predictions(spark, sf)
    write_csv(p, path)
    write_csv(p, path)  # a rerun replaces, never duplicates
    return from_file_names(read_results(spark, [path], _PRED_FILE_SCHEMA))


@register("row_to_csv", """
SELECT CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || CAST(c_nationkey AS VARCHAR) || ','
       || c_mktsegment AS line FROM customer
""")
def q_row_to_csv(spark, sf):
    return row_to_csv(table(spark, sf, "customer"), ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


_EVENT_SCHEMA = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


@register("publish_json", "SELECT event_id, user_id, event_type, value, props FROM events")
def q_publish_json(spark, sf):
    path = new_scratch(spark, "publish")
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    publish_json(ev, path)
    # consumer side (P21): parse the messages back with a pinned schema
    return spark.read.text(path).select(F.from_json("value", _EVENT_SCHEMA).alias("m")).select("m.*")


# An inline literal table (priority -> handling label).
_PRIORITY_LABELS = [("1-URGENT", "same day"), ("2-HIGH", "next day"), ("3-MEDIUM", "this week"),
                    ("4-NOT SPECIFIED", "unknown"), ("5-LOW", "this month")]


@register("inline_table", """
SELECT o.o_orderpriority AS priority, l.handling, count(*) AS orders
FROM orders o JOIN (VALUES ('1-URGENT', 'same day'), ('2-HIGH', 'next day'), ('3-MEDIUM', 'this week'),
                           ('4-NOT SPECIFIED', 'unknown'), ('5-LOW', 'this month')) AS l(priority, handling)
  ON o.o_orderpriority = l.priority
GROUP BY 1, 2
""")
def q_inline_table(spark, sf):
    labels = spark.createDataFrame(_PRIORITY_LABELS, "priority string, handling string")
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")) \
        .agg(F.count(F.lit(1)).alias("orders"))
    return decode(counts, labels, "priority", "inner").select("priority", "handling", "orders")


@register("lookup_decode", """
SELECT c.c_custkey, c.c_nationkey, n.n_name, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_lookup_decode(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return decode(decode(c, n, "c_nationkey"), r, "n_regionkey").select("c_custkey", "c_nationkey", "n_name", "r_name")


@register("code_lookup_file", """
SELECT 'nation_id' AS lookup, CAST(n_nationkey AS INTEGER) AS id, n_name AS description FROM nation
UNION ALL SELECT 'region_id', CAST(r_regionkey AS INTEGER), r_name FROM region
""")
def q_code_lookup_file(spark, sf):
    """The two code tables written as one stacked file, sections parted by lone-comma lines, and parsed back."""
    def section(name, key, label):
        lines = F.transform(F.sort_array(F.collect_list(F.struct(key, label))), lambda r: F.concat_ws(",", r[key].cast("string"), r[label]))
        return table(spark, sf, name).agg(F.concat(F.lit(f"{name}_id,description\n"), F.array_join(lines, "\n")).alias("t"))

    both = section("nation", "n_nationkey", "n_name").select(F.lit(1).alias("k"), "t").join(
        section("region", "r_regionkey", "r_name").select(F.lit(1).alias("k"), F.col("t").alias("u")), "k")
    path = new_scratch(spark, "codes")
    both.select(F.concat("t", F.lit("\n,\n"), "u").alias("value")).coalesce(1).write.text(path)
    return read_code_lookups(spark, path)


# The validation rules used on the part table.
_ALLOWED = {"p_type": ["ECONOMY", "SMALL", "LARGE"]}
_RANGES = {"p_size": (1, 30), "p_retailprice": (905, 995)}


@register("validate_domain", """
SELECT p_partkey,
       concat_ws(',',
         CASE WHEN p_retailprice < 905 OR p_retailprice > 995 THEN 'p_retailprice:range' END,
         CASE WHEN p_size < 1 OR p_size > 30 THEN 'p_size:range' END,
         CASE WHEN p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE') THEN 'p_type:domain' END) AS violations,
       NOT (p_retailprice < 905 OR p_retailprice > 995 OR p_size < 1 OR p_size > 30
            OR p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE')) AS is_valid
FROM part
""")
def q_validate_domain(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    v = validate_domain(p, _ALLOWED, _RANGES)
    return v.select("p_partkey", F.concat_ws(",", "violations").alias("violations"), "is_valid")


_PROFILE_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderpriority", "string")]


@register("column_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS name, '{t}' AS type, count(*) AS rows, count({c}) AS non_null, "
    f"count(DISTINCT {c}) AS distinct FROM orders" for c, t in _PROFILE_COLS))
def q_column_profile(spark, sf):
    o = table(spark, sf, "orders").select(*[c for c, _ in _PROFILE_COLS])
    return column_profile(o)


# Stand-in labels for the legacy scoring-profile codes.
_ADMISSION_BY_PRIORITY = {"1-URGENT": "Emergency", "2-HIGH": "Urgent", "3-MEDIUM": "Elective",
                          "4-NOT SPECIFIED": "Newborn", "5-LOW": "Trauma"}
_DISCHARGE_BY_STATUS = {"F": "Home", "O": "Transferred", "P": "Expired"}


def _case_sql(col, mapping):
    return "CASE " + col + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _case_int_sql(col, mapping):
    return "CASE " + col + " " + " ".join(f"WHEN '{k}' THEN {int(v)}" for k, v in mapping.items()) + " END"


@register("legacy_profile_encode", f"""
WITH l AS (SELECT o_orderkey, {_case_sql("o_orderpriority", _ADMISSION_BY_PRIORITY)} AS admission_type,
                  {_case_sql("o_orderstatus", _DISCHARGE_BY_STATUS)} AS discharge_disposition FROM orders)
SELECT o_orderkey, admission_type, discharge_disposition,
       CAST({_case_int_sql("admission_type", LEGACY_ADMISSION_TYPE)} AS INTEGER) AS admission_type_id,
       CAST({_case_int_sql("discharge_disposition", LEGACY_DISCHARGE)} AS INTEGER) AS discharge_disposition_id
FROM l
""")
def q_legacy_profile_encode(spark, sf):
    """Strict label -> id with the legacy profile codes; an unknown label raises."""
    o = table(spark, sf, "orders")
    adm = F.create_map(*[F.lit(x) for kv in _ADMISSION_BY_PRIORITY.items() for x in kv])
    dis = F.create_map(*[F.lit(x) for kv in _DISCHARGE_BY_STATUS.items() for x in kv])
    labelled = o.select("o_orderkey", F.try_element_at(adm, F.col("o_orderpriority")).alias("admission_type"),
                        F.try_element_at(dis, F.col("o_orderstatus")).alias("discharge_disposition"))
    a = encode_strict(labelled, lookup_frame(spark, LEGACY_ADMISSION_TYPE), "admission_type", "label", "id",
                      "admission_type_id")
    return encode_strict(a, lookup_frame(spark, LEGACY_DISCHARGE), "discharge_disposition", "label", "id",
                         "discharge_disposition_id")
