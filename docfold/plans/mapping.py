"""The test tables seen as a change log, as base tables and as nested inputs.

Every mapping uses all rows of its tables. The number of entities is the number of customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.spec import MARKER_SOURCE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; timestamps without zone are read as UTC."""
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for column, kind in frame.dtypes:
        if kind == "timestamp_ntz":
            frame = frame.withColumn(column, F.col(column).cast("timestamp"))
    return frame


def spread(frame: DataFrame, key: str) -> DataFrame:
    """A table of fewer files than cores, spread by key, so that reading JSON uses every core."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores, key)


def change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as row changes of the five tables, three in a row for one customer."""
    entities = table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    seq = F.col("event_id")
    third = F.expr("event_id div 3")
    raw = spread(table(spark, sf_dir, "events"), "event_id").select(
        seq.alias("seq"),
        "ts",
        "value",
        "props",
        F.when(seq % 41 != 0, F.concat_ws(":", F.expr("event_id div 6"), 1000 + seq)).alias("raw_txn"),
        F.expr(
            "case when event_id % 97 = 0 or event_type = 'signup' then 'customers'"
            " when event_type = 'view' then 'customer_profiles'"
            " when event_type = 'purchase' then 'customer_addresses'"
            " when event_type = 'click' or event_id % 2 = 0 then 'customer_contacts'"
            " else 'customer_preferences' end"
        ).alias("source"),
        F.expr(
            "case when event_id % 97 = 0 or event_id % 31 = 0"
            " or (event_type = 'error' and event_id % 2 = 0) then 'd'"
            " when event_id % 41 = 0 then 'r' else 'u' end"
        ).alias("op"),
        F.pmod(third, entities).alias("cid"),
        F.pmod(third + 1, entities).alias("neighbour"),
        F.expr(
            "case when event_type = 'purchase' then 8 + event_id % 5 else 95 + event_id % 10 end"
        ).alias("row_id"),
    )
    is_many = F.col("source").isin("customer_addresses", "customer_contacts")
    moved = is_many & (F.col("op") == "u") & (F.col("seq") % 53 == 0)
    return raw.select(
        "*",
        F.when(F.col("op") != "d", F.col("cid")).alias("after_cid"),
        F.when(moved, F.col("neighbour"))
        .when(F.col("op") != "r", F.col("cid"))
        .alias("before_cid"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze log: row events and markers as JSON records."""
    rows = change_rows(spark, sf_dir)
    return _row_records(rows).unionByName(_marker_records(rows))


def _row_records(rows: DataFrame) -> DataFrame:
    source, seq, millis = F.col("source"), F.col("seq"), F.unix_millis("ts")
    customers = F.to_json(
        F.struct(
            F.col("cid").alias("id"),
            F.concat(F.lit("CUS-"), "cid").alias("customer_number"),
            F.concat(F.lit("F"), "seq").alias("first_name"),
            F.concat(F.lit("L"), "cid").alias("last_name"),
            F.when(seq % 5 != 0, seq % 20000).alias("date_of_birth"),
            _choice(seq % 3, "active", "inactive", "suspended").alias("status"),
            millis.alias("created_at"),
            millis.alias("updated_at"),
        ),
        {"ignoreNullFields": "false"},
    )
    profiles = F.to_json(
        F.struct(
            F.col("cid").alias("customer_id"),
            _choice(seq % 4, "en", "fr", "de").alias("preferred_language"),
            F.col("value").cast("decimal(14,2)").cast("string").alias("annual_income"),
            millis.alias("updated_at"),
        ),
        {"ignoreNullFields": "false"},
    )
    addresses = F.to_json(
        F.struct(
            F.col("row_id").alias("id"),
            F.col("after_cid").alias("customer_id"),
            _choice(seq % 3, "residential", "mailing", "work").alias("address_type"),
            F.concat(F.lit("L"), "seq").alias("line_1"),
            (seq % 20000).alias("valid_from"),
            millis.alias("updated_at"),
        )
    )
    contacts = F.to_json(
        F.struct(
            F.col("row_id").alias("id"),
            F.col("after_cid").alias("customer_id"),
            _choice(seq % 3, "email", "mobile_phone", "home_phone").alias("contact_type"),
            F.concat(F.lit("v"), "seq").alias("contact_value"),
            (seq % 2 == 1).alias("is_primary"),
            millis.alias("updated_at"),
        )
    )
    preferences = F.to_json(
        F.struct(
            F.col("cid").alias("customer_id"),
            (seq % 2 == 0).alias("marketing_email_opt_in"),
            F.col("props").alias("notification_channels"),
            millis.alias("updated_at"),
        )
    )
    image = (
        F.when(source == "customers", customers)
        .when(source == "customer_profiles", profiles)
        .when(source == "customer_addresses", addresses)
        .when(source == "customer_contacts", contacts)
        .otherwise(preferences)
    )
    is_root = source == "customers"
    is_many = source.isin("customer_addresses", "customer_contacts")
    root_key = F.to_json(F.struct(F.col("cid").alias("id")))
    owner_key = F.to_json(F.struct(F.col("cid").alias("customer_id")))
    row_key = F.to_json(F.struct(F.col("row_id").alias("id")))
    full_before = F.to_json(
        F.struct(F.col("row_id").alias("id"), F.col("before_cid").alias("customer_id"))
    )
    # Only the two collections log full before-images; the other tables log the key on delete.
    before = (
        F.when(is_many & F.col("before_cid").isNotNull(), full_before)
        .when(~is_many & (F.col("op") == "d"), F.when(is_root, root_key).otherwise(owner_key))
    )
    after = F.when(F.col("op") != "d", image)
    tail = F.when(
        F.col("raw_txn").isNotNull(), F.concat(F.lit(',"transaction":{"id":"'), "raw_txn", F.lit('"}'))
    )
    return rows.select(
        "source",
        F.when(is_root, root_key).when(is_many, row_key).otherwise(owner_key).alias("key"),
        F.concat(
            F.lit('{"op":"'),
            "op",
            F.lit('","before":'),
            F.coalesce(before, F.lit("null")),
            F.lit(',"after":'),
            F.coalesce(after, F.lit("null")),
            F.coalesce(tail, F.lit("")),
            F.lit("}"),
        ).alias("value"),
        "seq",
        F.col("ts").alias("at"),
    )


def _marker_records(rows: DataFrame) -> DataFrame:
    """END markers: most are right, some count one too many or too few, some are missing."""
    number = F.expr("seq div 6")
    counted = (
        rows.filter(F.col("raw_txn").isNotNull())
        .groupBy(number.alias("number"))
        .agg(F.count("*").alias("seen"), F.max("seq").alias("seq"), F.max("ts").alias("at"))
        .filter("number % 10 <> 9")
    )
    off = F.when(F.col("number") % 13 == 0, 1).when(F.col("number") % 17 == 0, -1).otherwise(0)
    return counted.select(
        F.lit(MARKER_SOURCE).alias("source"),
        F.col("number").cast("string").alias("key"),
        F.to_json(
            F.struct(
                F.lit("END").alias("status"),
                F.concat_ws(":", "number", F.lit("999")).alias("id"),
                (F.col("seen") + off).alias("event_count"),
            )
        ).alias("value"),
        "seq",
        "at",
    )


def _choice(index: Column, *values: str) -> Column:
    picked = F.when(index == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        picked = picked.when(index == i, value)
    return picked


def base_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five base tables from customer, nation, region, orders and events."""
    customer = table(spark, sf_dir, "customer")
    key, nation_key = F.col("c_custkey"), F.col("c_nationkey")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    created = F.timestamp_seconds(F.unix_seconds(start) + key)
    updated = F.timestamp_seconds(F.unix_seconds(start) + key + nation_key * 86400)
    customers = customer.select(
        key.alias("id"),
        F.col("c_name").alias("customer_number"),
        F.col("c_mktsegment").alias("first_name"),
        F.concat(F.lit("N"), nation_key.cast("string")).alias("last_name"),
        F.when(key % 7 != 0, F.date_from_unix_date((key % 20000).cast("int"))).alias(
            "date_of_birth"
        ),
        _choice(key % 3, "active", "inactive", "suspended").alias("status"),
        created.alias("created_at"),
        updated.alias("updated_at"),
    )
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    profiles = (
        customer.filter("c_acctbal >= 0")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("customer_id"),
            _choice(nation_key % 3, "en", "fr", "de").alias("preferred_language"),
            F.when(key % 5 != 0, F.col("n_name")).alias("occupation"),
            F.col("c_acctbal").cast("decimal(14,2)").alias("annual_income"),
            F.upper(F.substring("r_name", 1, 2)).alias("tax_residency_country"),
            _choice(F.col("r_regionkey") % 3, "low", "standard", "high").alias("risk_rating"),
            updated.alias("updated_at"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    order_key, ordered = F.col("o_orderkey"), F.col("o_orderdate")
    addresses = orders.select(
        order_key.alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.expr(
            "case substr(o_orderpriority, 1, 1) when '1' then 'residential' when '2' then 'mailing'"
            " when '3' then 'mailing' else 'work' end"
        ).alias("address_type"),
        F.concat(F.lit("Street "), order_key.cast("string")).alias("line_1"),
        F.when(order_key % 4 == 0, F.col("o_orderpriority")).alias("line_2"),
        F.concat(F.lit("City "), F.col("o_orderstatus")).alias("city"),
        F.lit(None).cast("string").alias("region"),
        (10000 + order_key % 80000).cast("string").alias("postal_code"),
        F.lit("US").alias("country_code"),
        ordered.cast("date").alias("valid_from"),
        F.when(
            F.col("o_orderstatus") == "F", F.date_add(ordered.cast("date"), 30)
        ).alias("valid_to"),
        ordered.alias("created_at"),
        ordered.alias("updated_at"),
    )
    events = table(spark, sf_dir, "events")
    event_id = F.col("event_id")
    contacts = events.select(
        event_id.alias("id"),
        F.col("user_id").alias("customer_id"),
        F.expr(
            "case event_type when 'view' then 'email' when 'click' then 'mobile_phone'"
            " else 'home_phone' end"
        ).alias("contact_type"),
        F.concat(F.lit("v"), event_id.cast("string")).alias("contact_value"),
        (event_id % 50 == 1).alias("is_primary"),
        F.when(event_id % 3 == 0, F.col("ts")).alias("verified_at"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
    )
    preferences = customer.filter("c_custkey % 4 <> 3").select(
        key.alias("customer_id"),
        (key % 2 == 0).alias("marketing_email_opt_in"),
        (key % 3 == 0).alias("marketing_sms_opt_in"),
        (key % 5 != 0).alias("paperless_statements"),
        F.concat(
            F.lit('{"email":'),
            F.when(key % 2 == 0, "true").otherwise("false"),
            F.lit(',"sms":'),
            F.when(key % 7 == 0, '"yes"').otherwise("false"),
            F.lit("}"),
        ).alias("notification_channels"),
        updated.alias("updated_at"),
    )
    return {
        "customers": customers,
        "customer_profiles": profiles,
        "customer_addresses": addresses,
        "customer_contacts": contacts,
        "customer_preferences": preferences,
    }
