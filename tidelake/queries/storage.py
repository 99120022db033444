"""Source and sink queries: write a layout, read it back.

The written folders lie in the shared folder of the session.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tidelake.functions.columns import plus_days
from tidelake.operators.surrogate_keys import insert_with_keys
from tidelake.plans.rental_mart import build_mart
from tidelake.plans.reports import write_pivot
from tidelake.queries import tables as t
from tidelake.session import new_folder
from tidelake.sinks import tables as ddl
from tidelake.sinks.partitioned import compact, write_partitioned
from tidelake.sinks.publish import compact_small, publish_batch, stored_files
from tidelake.sinks.text import line_values, write_partition_lines
from tidelake.sources.files import ANY_TEXT, read_csv, read_lines
from tidelake.sources.inference import infer_types as types_of, read_csv_typed
from tidelake.sources.tables import literal_rows as rows_of, read_table

_KEYS = ["store_id", "rental_dt"]
_LAYOUT = """
    SELECT event_id, ts AS payment_date, CAST(value AS DECIMAL(10,2)) AS amount,
           event_type AS store_id, strftime(ts, '%Y-%m-%d') AS rental_dt
    FROM events
"""
_CODED = """
    SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 20, '0') AS code, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
           CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) + INTERVAL 750 MINUTE AS moment,
           o_orderkey % 2 = 0 AS even, o_orderstatus
    FROM orders
"""
_DAYS = "o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate"


def _orders(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )


def _table_name(label):
    return f"{label}_{uuid.uuid4().hex}"


def scan_csv_header(spark, sf_dir):
    return read_csv(spark, t.write_csv(_orders(spark, sf_dir), new_folder(spark, "csv")))


def scan_csv_infer(spark, sf_dir):
    """Numbers are inferred as int or bigint by their size; the query fixes the wider one."""
    found = read_csv(spark, t.write_csv(_orders(spark, sf_dir), new_folder(spark, "csv")), infer=True)
    return found.withColumns({name: F.col(name).cast("bigint") for name in ("o_orderkey", "o_custkey")})


def _coded_orders(spark, sf_dir):
    """Orders with a code that must keep its zeros, an amount, a day and a moment, as CSV."""
    rows = t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lpad(F.col("o_custkey").cast("string"), 20, "0").alias("code"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T12:30:00")).alias("moment"),
        (F.col("o_orderkey") % 2 == 0).alias("even"),
        "o_orderstatus",
    )
    return t.write_csv(rows, new_folder(spark, "csv"))


def scan_csv_typed(spark, sf_dir):
    """Types that lose no text; the digits of the amounts follow the data, the query fixes them."""
    found = read_csv_typed(spark, _coded_orders(spark, sf_dir))
    return found.withColumn("price", F.col("price").cast("decimal(18,2)"))


def infer_types(spark, sf_dir):
    """The inferred type of each column."""
    return types_of(read_csv(spark, _coded_orders(spark, sf_dir)))


def scan_text(spark, sf_dir):
    folder = new_folder(spark, "text")
    t.table(spark, sf_dir, "pages").select(F.col("url").alias("value")).write.text(folder)
    return read_lines(spark, folder)


def scan_catalog(spark, sf_dir):
    name = _table_name("customer")
    ddl.create_parquet_table(
        spark, name, "customer_id BIGINT, store_id INT, name STRING, balance DOUBLE", new_folder(spark, "table")
    )
    ddl.insert_rows(t.customer(spark, sf_dir), name)
    found = read_table(spark, name, "default")
    spark.sql(f"DROP TABLE {name}")  # the files stay, and with them the result
    return found


def literal_rows(spark, sf_dir):
    """A rule table written in the program, joined to all events; some have no rule."""
    rules = rows_of(
        spark,
        [("click", "traffic", 1), ("view", "traffic", 1), ("purchase", "sale", 5)],
        "event_type string, kind string, weight int",
    )
    return t.events(spark, sf_dir).join(F.broadcast(rules), "event_type", "left").select(
        "event_id", "event_type", "kind", "weight"
    )


def sink_partitioned_parquet(spark, sf_dir):
    folder = new_folder(spark, "layout")
    write_partitioned(t.layout_rows(spark, sf_dir), folder, _KEYS)
    return spark.read.schema(t.LAYOUT_SCHEMA).parquet(folder)


def sink_partitioned_csv_overwrite(spark, sf_dir):
    folder = new_folder(spark, "layout")
    rows = t.layout_rows(spark, sf_dir).withColumn("note", t.odd_text(F.col("event_id")))
    write_partitioned(rows, folder, _KEYS, file_format="csv", **ANY_TEXT)
    again = rows.filter(F.col("store_id") == "click").withColumn("amount", -F.col("amount"))
    write_partitioned(again, folder, _KEYS, file_format="csv", **ANY_TEXT)  # other stores stay
    return read_csv(spark, folder, schema=_NOTED_SCHEMA, **ANY_TEXT)


def compact_one_file(spark, sf_dir):
    """Rows and files per directory after a layout that grew by appends is compacted."""
    loose, tight = new_folder(spark, "layout"), new_folder(spark, "layout")
    rows = t.layout_rows(spark, sf_dir)
    small = F.coalesce(F.col("amount") < 50, F.lit(False))
    for part in (rows.filter(small), rows.filter(~small)):
        write_partitioned(part, loose, _KEYS, mode="append")
    compact(spark, loose, tight, _KEYS)
    stored = spark.read.schema(t.LAYOUT_SCHEMA).parquet(tight)
    per_file = stored.groupBy(*_KEYS, F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    # A directory has one file, or several where it exceeds the advisory size.
    return per_file.groupBy(*_KEYS).agg(F.sum("rows").alias("rows"), (F.count(F.lit(1)) >= 1).alias("has_files"))


def _per_directory(files):
    names = [F.regexp_extract("directory", f"/{key}=([^/]*)", 1).alias(key) for key in _KEYS]
    return files.filter("path NOT LIKE '%/_published/%'").groupBy(*names).agg(F.count(F.lit(1)).alias("files"))


def compact_selective(spark, sf_dir):
    """Files of each directory before and after the small ones are merged, with its rows.

    The clicks came in three appends; directories of one file stay as they are.
    """
    folder = new_folder(spark, "layout")
    rows = t.layout_rows(spark, sf_dir)
    write_partitioned(rows.filter("store_id <> 'click'"), folder, _KEYS, mode="append")
    for part in range(3):
        write_partitioned(rows.filter((F.col("store_id") == "click") & (F.col("event_id") % 3 == part)), folder, _KEYS, mode="append")
    before = t.kept(_per_directory(stored_files(spark, folder)))
    compact_small(spark, folder, _KEYS)
    after = _per_directory(stored_files(spark, folder)).withColumnRenamed("files", "files_after")
    stored = spark.read.schema(t.LAYOUT_SCHEMA).parquet(folder).groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("rows"))
    return before.withColumnRenamed("files", "files_before").join(after, _KEYS).join(stored, _KEYS)


def publish_once(spark, sf_dir):
    """A layout after three batches, of which two were appended again."""
    folder = new_folder(spark, "layout")
    rows = t.layout_rows(spark, sf_dir)
    for part in (0, 1, 1, 2, 0):
        publish_batch(rows.filter(F.col("event_id") % 3 == part), folder, _KEYS, f"part-{part}")
    return spark.read.schema(t.LAYOUT_SCHEMA).parquet(folder)


# The columns of the files in order, then those of the directories.
_NOTED_SCHEMA = (
    "event_id BIGINT, payment_date TIMESTAMP_NTZ, amount DECIMAL(10,2), note STRING, "
    "store_id STRING, rental_dt STRING"
)


def _external(spark, sf_dir):
    folder, name = new_folder(spark, "layout"), _table_name("rental_payment")
    rows = t.layout_rows(spark, sf_dir).withColumn("note", t.odd_text(F.col("event_id")))
    write_partitioned(rows, folder, _KEYS, file_format="csv", **ANY_TEXT)
    ddl.create_csv_table(spark, name, _NOTED_SCHEMA, _KEYS, folder, **ANY_TEXT)
    ddl.recover_partitions(spark, name)
    return name


def external_csv_table(spark, sf_dir):
    return spark.table(_external(spark, sf_dir))


def recover_partitions(spark, sf_dir):
    """The registered partitions, with the rows each of them serves."""
    return spark.table(_external(spark, sf_dir)).groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("rows"))


def insert_rows(spark, sf_dir):
    """Chained inserts: new customers get keys, then each rents once."""
    customers, rentals = _table_name("customer"), _table_name("rental")
    ddl.create_parquet_table(
        spark, customers, "customer_id BIGINT, store_id INT, name STRING, active BOOLEAN", new_folder(spark, "table")
    )
    ddl.create_parquet_table(
        spark,
        rentals,
        "rental_id BIGINT, customer_id BIGINT, rental_date TIMESTAMP_NTZ, return_date TIMESTAMP_NTZ, staff_id INT",
        new_folder(spark, "table"),
    )
    known = t.customer(spark, sf_dir).select("customer_id", "store_id", "name")
    ddl.insert_rows(known, customers)
    new = t.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("store_id"), F.lit(True).alias("active")
    )
    state = new_folder(spark, "marks")
    insert_with_keys(
        known, "customer_id", new, ["name"], lambda rows: ddl.insert_rows(rows, customers), f"{state}/customer"
    )

    now = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    rented = spark.table(customers).filter("active").select(
        "customer_id",
        now.alias("rental_date"),
        plus_days(now, 4).alias("return_date"),
    )
    insert_with_keys(
        t.rental(spark, sf_dir),
        "rental_id",
        rented,
        ["customer_id"],
        lambda rows: ddl.insert_rows(rows, rentals),
        f"{state}/rental",
    )
    found = spark.table(customers).join(spark.table(rentals), "customer_id", "left")
    for name in (customers, rentals):
        spark.sql(f"DROP TABLE {name}")  # the files stay, and with them the result
    return found


def reserved_keys(spark, sf_dir):
    """Customers and parts take order keys at the same time; who comes first is open.

    Per row its place in the keys of its batch, how many rows hold its key, and the
    greatest key of all.
    """
    ledger, folder = new_folder(spark, "ledger"), new_folder(spark, "keyed")
    existing = t.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    batches = {
        "customer": t.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")),
        "part": t.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id")),
    }

    def write(writer):
        def keep(rows):
            rows.write.parquet(f"{folder}/writer={writer}")

        insert_with_keys(existing, "key", batches[writer], ["id"], keep, ledger=ledger)

    with ThreadPoolExecutor(len(batches)) as writers:
        list(writers.map(write, batches))
    stored = spark.read.schema("id long, key long, writer string").parquet(folder)
    holders = stored.groupBy("key").agg(F.count(F.lit(1)).alias("holders"))
    firsts = stored.groupBy("writer").agg((F.min("key") - 1).alias("before"))
    greatest = stored.agg(F.max("key")).first()[0]
    return stored.join(holders, "key").join(firsts, "writer").select(
        "writer", "id", (F.col("key") - F.col("before")).alias("place"), "holders", F.lit(greatest).cast("long").alias("greatest")
    )


def sink_text(spark, sf_dir):
    """Values written as lists, one line per part of a partition, and taken apart again."""
    folder = new_folder(spark, "lines")
    names = t.customer(spark, sf_dir).select("name", t.odd_text(F.col("customer_id")).alias("note"))
    write_partition_lines(names, F.coalesce("note", "name"), f"{folder}/a")
    write_partition_lines(names, F.col("note"), f"{folder}/b")
    parts = [
        read_lines(spark, f"{folder}/{part}").select(F.lit(part).alias("part"), F.explode(line_values(F.col("value"))).alias("name"))
        for part in ("a", "b")
    ]
    return parts[0].union(parts[1])


def pivot_job(spark, sf_dir):
    """The pivot job, read back from its text lines."""
    target = new_folder(spark, "pivot")
    write_pivot(t.events(spark, sf_dir), "user_id", "event_type", "value", target)
    kind = "struct<user_id:bigint," + ",".join(f"{name}:double" for name in t.EVENT_TYPES) + ">"
    rows = read_lines(spark, f"{target}/lines").select(F.explode(line_values(F.col("value"))).alias("row"))
    return rows.select(F.from_json("row", kind).alias("row")).select("row.*")


def _mart(spark, sf_dir, keys, rental):
    _, payment, customer = t.rental_tables(spark, sf_dir)
    files = {
        role: t.write_csv(df, new_folder(spark, role))
        for role, df in (("rental", rental), ("payment", payment), ("customer", customer))
    }
    target = new_folder(spark, "mart")
    build_mart(spark, files, target, keys=keys)
    columns = "store_id STRING, rental_date STRING, payment_date STRING, amount STRING"
    if "rental_dt" in keys:
        columns += ", rental_dt STRING"
    stored = spark.read.schema(columns).parquet(target)
    return stored.withColumns({
        "store_id": F.col("store_id").cast("int"),
        "payment_date": F.col("payment_date").cast("timestamp_ntz"),
        "amount": F.col("amount").cast("double"),
    })


def rental_mart(spark, sf_dir):
    """The whole mart job: three CSV inputs, one fact layout, read back."""
    return _mart(spark, sf_dir, ["store_id"], t.rental(spark, sf_dir))


def rental_mart_days(spark, sf_dir):
    """The mart in its layout by store and day, over the rentals that pass for one month.

    All rentals take part: the days of a year are folded to those of one
    month, so that there are at most 31 directories for each store.
    """
    day = F.concat(F.lit("2024-01-"), F.date_format("rental_date", "dd")).cast("date")
    rental = t.rental(spark, sf_dir).withColumn("rental_date", day)
    return _mart(spark, sf_dir, ["store_id", "rental_dt"], rental)


QUERIES = {
    "scan_csv_header": scan_csv_header,
    "scan_csv_infer": scan_csv_infer,
    "scan_csv_typed": scan_csv_typed,
    "infer_types": infer_types,
    "scan_text": scan_text,
    "scan_catalog": scan_catalog,
    "literal_rows": literal_rows,
    "sink_partitioned_parquet": sink_partitioned_parquet,
    "sink_partitioned_csv_overwrite": sink_partitioned_csv_overwrite,
    "compact_one_file": compact_one_file,
    "compact_selective": compact_selective,
    "publish_once": publish_once,
    "external_csv_table": external_csv_table,
    "recover_partitions": recover_partitions,
    "insert_rows": insert_rows,
    "reserved_keys": reserved_keys,
    "sink_text": sink_text,
    "pivot_job": pivot_job,
    "rental_mart": rental_mart,
    "rental_mart_days": rental_mart_days,
}

SQL = {
    "scan_csv_header": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
        FROM orders
    """,
    "scan_csv_infer": f"SELECT {_DAYS} FROM orders",
    "scan_csv_typed": _CODED,
    "infer_types": f"""
        WITH texts AS (
          UNPIVOT (SELECT CAST(COLUMNS(* EXCLUDE moment) AS VARCHAR), strftime(moment, '%Y-%m-%dT%H:%M:%S') AS moment FROM ({_CODED}))
          ON o_orderkey, code, price, day, moment, even, o_orderstatus INTO NAME "column" VALUE v
        )
        SELECT "column", count(v) AS filled, CASE
          WHEN bool_and(regexp_full_match(v, '0|-?[1-9][0-9]*')) THEN 'bigint'
          WHEN bool_and(regexp_full_match(v, '-?(0|[1-9][0-9]*)\.[0-9]+'))
            THEN 'decimal(' || (max(length(regexp_replace(v, '^-?0?|\.[0-9]*$', '', 'g'))) + 2) || ',2)'
          WHEN bool_and(try_cast(v AS DATE) IS NOT NULL AND length(v) = 10) THEN 'date'
          WHEN bool_and(try_cast(v AS TIMESTAMP) IS NOT NULL) THEN 'timestamp_ntz'
          WHEN bool_and(v IN ('true', 'false')) THEN 'boolean'
          ELSE 'string' END AS type
        FROM texts GROUP BY "column"
    """,
    "scan_text": "SELECT url AS value FROM pages",
    "scan_catalog": """
        SELECT c_custkey AS customer_id, c_nationkey AS store_id, c_name AS name, c_acctbal AS balance
        FROM customer
    """,
    "literal_rows": """
        SELECT event_id, event_type, kind, weight
        FROM events LEFT JOIN (VALUES ('click', 'traffic', 1), ('view', 'traffic', 1), ('purchase', 'sale', 5))
             AS r(event_type, kind, weight) USING (event_type)
    """,
    "sink_partitioned_parquet": _LAYOUT,
    "sink_partitioned_csv_overwrite": f"""
        SELECT event_id, payment_date, store_id, rental_dt, {t.odd_sql("event_id")} AS note,
               CASE WHEN store_id = 'click' THEN -amount ELSE amount END AS amount
        FROM ({_LAYOUT})
    """,
    "compact_one_file": f"""
        SELECT store_id, rental_dt, count(*) AS rows, true AS has_files FROM ({_LAYOUT}) GROUP BY ALL
    """,
    "compact_selective": f"""
        SELECT store_id, rental_dt, CASE WHEN store_id = 'click' THEN count(DISTINCT event_id % 3) ELSE 1 END AS files_before,
               1::BIGINT AS files_after, count(*) AS rows
        FROM ({_LAYOUT}) GROUP BY store_id, rental_dt
    """,
    "publish_once": _LAYOUT,
    "external_csv_table": f"SELECT *, {t.odd_sql('event_id')} AS note FROM ({_LAYOUT})",
    "recover_partitions": f"SELECT store_id, rental_dt, count(*) AS rows FROM ({_LAYOUT}) GROUP BY ALL",
    "insert_rows": """
        SELECT c_custkey AS customer_id, c_nationkey AS store_id, c_name AS name, NULL::BOOLEAN AS active,
               NULL::BIGINT AS rental_id, NULL::TIMESTAMP AS rental_date, NULL::TIMESTAMP AS return_date,
               NULL::INTEGER AS staff_id
        FROM customer
        UNION ALL
        SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name), s_nationkey, s_name,
               true, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY s_name),
               TIMESTAMP '2024-01-01 10:00:00', TIMESTAMP '2024-01-05 10:00:00', NULL
        FROM supplier
    """,
    "reserved_keys": """
        SELECT *, 1::BIGINT AS holders,
               (SELECT max(o_orderkey) FROM orders) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM part) AS greatest
        FROM (SELECT 'customer' AS writer, c_custkey AS id, row_number() OVER (ORDER BY c_custkey) AS place FROM customer
              UNION ALL SELECT 'part', p_partkey, row_number() OVER (ORDER BY p_partkey) FROM part)
    """,
    "sink_text": f"""
        SELECT 'a' AS part, coalesce({t.odd_sql("c_custkey")}, c_name) AS name FROM customer
        UNION ALL SELECT 'b', {t.odd_sql("c_custkey")} FROM customer
    """,
    "pivot_job": "SELECT user_id, " + ", ".join(
        f"coalesce(max(CASE WHEN event_type = '{e}' THEN value END), 0.0) AS \"{e}\"" for e in t.EVENT_TYPES
    ) + " FROM events GROUP BY user_id",
    "rental_mart": """
        SELECT c_nationkey AS store_id, strftime(o_orderdate, '%Y-%m-%d') AS rental_date,
               l_shipdate AS payment_date, l_extendedprice AS amount
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
    """,
    "rental_mart_days": """
        SELECT c_nationkey AS store_id, strftime(o_orderdate, '2024-01-%d') AS rental_date,
               strftime(o_orderdate, '2024-01-%d') AS rental_dt,
               l_shipdate AS payment_date, l_extendedprice AS amount
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
    """,
}
