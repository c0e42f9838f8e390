"""The driver's star-schema tables, projected to the five rails.

The tables hold no payments, so each rail is a fixed projection of one of them. It keeps what makes
the rails hard: several versions per key, NULLs in keys, codes, dates and amounts, untidy codes, and
documents of varying shape. Every projection covers every row of its table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard import contracts
from railyard.rails import ACH
from railyard.session import pin_utc, small_tasks
from railyard.sources.documents import WRITE_OPTIONS, project_documents
from railyard.sources.topic import encode

# Declared, so that no job has to infer them.
TABLES = {
    "customer": contracts.contract(
        c_custkey="bigint", c_name="string", c_nationkey="int", c_acctbal="double", c_mktsegment="string"
    ),
    "supplier": contracts.contract(s_suppkey="bigint", s_name="string", s_nationkey="int", s_acctbal="double"),
    "orders": contracts.contract(
        o_orderkey="bigint", o_custkey="bigint", o_orderstatus="string", o_totalprice="double", o_orderdate="moment",
        o_orderpriority="string",
    ),
    "lineitem": contracts.contract(
        l_orderkey="bigint", l_partkey="bigint", l_suppkey="bigint", l_linenumber="int", l_quantity="double",
        l_extendedprice="double", l_discount="double", l_tax="double", l_returnflag="string", l_linestatus="string",
        l_shipdate="moment",
    ),
    "events": contracts.contract(
        event_id="bigint", ts="moment", user_id="bigint", event_type="string", value="double", props="string"
    ),
    "documents": contracts.contract(
        doc_id="bigint", text="string", lang="string", source="string", n_chars="bigint"
    ),
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    pin_utc(spark)
    small_tasks(spark)
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number inside ``props`` parsed once."""
    return load(spark, sf_dir, "events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS BIGINT) AS number")


def _bronze(rows: DataFrame, table: str, **columns: str) -> DataFrame:
    """Project by SQL expressions and cast to the bronze contract."""
    schema = contracts.BRONZE[table]
    return rows.selectExpr([f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields])


def ach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order's customer and its supplier as the two banks."""
    line = load(spark, sf_dir, "lineitem")
    payer = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    rows = line.join(payer, F.expr("l_orderkey = o_orderkey")).join(
        load(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey")
    )
    return _bronze(
        rows,
        "ach_transactions",
        txn_id="concat(l_orderkey, '-', l_linenumber)",
        batch_id="concat('B', l_suppkey)",
        txn_type="element_at(array(' credit ', 'Debit', 'RETURN'), l_linenumber % 3 + 1)",
        originating_bank_id="concat(' bnk', c_nationkey)",
        receiving_bank_id="concat('Bnk', s_nationkey, ' ')",
        originator_account="concat('ACC', o_custkey)",
        receiver_account="concat('ACC', l_suppkey)",
        amount_egp="if(l_partkey % 97 = 0, NULL, l_extendedprice)",
        currency_code="if(l_partkey % 5 = 0, NULL, 'EGP')",
        txn_status="""CASE WHEN l_returnflag = 'R' THEN ' returned ' WHEN l_returnflag = 'A' THEN 'Settled'
                           WHEN l_linestatus = 'F' THEN 'FAILED' ELSE 'pending' END""",
        created_at="l_shipdate",
        settlement_date="if(l_partkey % 50 = 0, NULL, CAST(l_shipdate AS DATE))",
    )


def meeza(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(
        load(spark, sf_dir, "orders"),
        "meeza_authorisations",
        auth_id="concat('A', o_orderkey)",
        card_token="if(o_custkey % 29 = 0, NULL, concat('tok_', o_custkey))",
        merchant_id="if(o_orderkey % 31 = 0, NULL, concat('M', o_custkey % 500))",
        merchant_category="element_at(array('GROCERY', 'FUEL', 'TRAVEL', NULL), CAST(o_orderkey % 4 + 1 AS INT))",
        terminal_id="if(o_orderkey % 5 = 0, NULL, concat('T', o_custkey % 97))",
        txn_type="if(o_orderkey % 9 = 0, 'Refund', 'purchase')",
        channel="""CASE o_orderpriority WHEN '1-URGENT' THEN ' pos' WHEN '2-HIGH' THEN 'ecommerce '
                        WHEN '3-MEDIUM' THEN 'Atm' WHEN '4-NOT SPECIFIED' THEN 'contactless' END""",
        amount_egp="o_totalprice",
        currency_code="'EGP'",
        response_code="element_at(array('00', '05', '51', '14', NULL, '00'), CAST(o_orderkey % 6 + 1 AS INT))",
        auth_status="""CASE WHEN o_custkey % 37 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'approved'
                            WHEN o_orderstatus = 'O' THEN ' Declined ' ELSE 'reversed' END""",
        issuing_bank_id="concat('BNK', o_custkey % 25)",
        acquiring_bank_id="if(o_orderkey % 11 = 0, NULL, concat('BNK', o_orderkey % 25))",
        is_international="if(o_orderkey % 10 = 0, NULL, o_orderkey % 33 = 0)",
        auth_timestamp="o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)",
        settlement_date="if(o_orderkey % 3 = 0, NULL, date_add(CAST(o_orderdate AS DATE), 1))",
    )


def ipn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one user in one hour are versions of one payment."""
    return _bronze(
        events(spark, sf_dir),
        "ipn_transactions",
        txn_id="concat(user_id, '-', date_format(ts, 'yyyyMMddHH'))",
        payment_ref="concat(' PR', event_id)",
        sender_proxy="if(user_id % 41 = 0, NULL, concat('U', user_id))",
        receiver_proxy="concat('R', number)",
        sender_bank_id="concat(' bnk', user_id % 25)",
        receiver_bank_id="if(number = 7, NULL, concat('Bnk', number % 25))",
        amount_egp="value",
        payment_purpose="""CASE event_type WHEN 'purchase' THEN 'merchant' WHEN 'view' THEN ' bill '
                                WHEN 'click' THEN 'salary' WHEN 'error' THEN 'p2p' END""",
        txn_status="""CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'view' THEN ' Completed'
                           WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'reversed' ELSE 'processing' END""",
        failure_reason="if(event_type = 'error', ' timeout ', NULL)",
        initiation_channel="element_at(array('instapay_app', ' Bank_App', 'USSD', NULL), CAST(event_id % 4 + 1 AS INT))",
        processing_time_ms="if(event_id % 53 = 0, NULL, floor(value * 10))",
        initiated_at="ts",
        completed_at="if(event_type = 'click', NULL, ts + INTERVAL 2 SECONDS)",
    )


def wallet_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per event; each event type has fields of its own. Absent fields are left out."""
    fields = {
        "_id": "concat('W', event_id)",
        "wallet_id": "if(number % 10 = 0, NULL, concat('WLT', number))",
        "event_type": """CASE event_type WHEN 'purchase' THEN 'merchant_payment' WHEN 'view' THEN 'qr_payment'
                              WHEN 'click' THEN 'wallet_transfer' WHEN 'signup' THEN 'top_up' ELSE 'withdrawal' END""",
        "channel": "if(number % 13 = 0, NULL, if(number % 2 = 0, 'mobile_app', 'Ussd'))",
        "issuing_bank_id": "concat('BNK', user_id % 25)",
        "amount_egp": "if(number = 50, NULL, CAST(value AS DECIMAL(18,2)))",
        "status": """element_at(array('completed', 'Completed', 'Failed', 'pending', 'rejected'),
                                CAST(event_id % 5 + 1 AS INT))""",
        "event_ts": "CAST(ts AS TIMESTAMP)",
        "bank_ref": "if(event_type = 'signup', concat('TR', event_id), NULL)",
        "merchant_id": "if(event_type IN ('purchase', 'view'), concat('MER', user_id), NULL)",
        "qr_ref": "if(event_type IN ('purchase', 'view'), concat('QR', event_id), NULL)",
        "receiver_wallet_id": "if(event_type = 'click', concat('WLT', user_id), NULL)",
        "atm_id": "if(event_type = 'error', concat('ATM', number), NULL)",
    }
    shaped = events(spark, sf_dir).selectExpr("event_id", *[f"{e} AS {name}" for name, e in fields.items()])
    return shaped.select("event_id", F.to_json(F.struct(*fields), WRITE_OPTIONS).alias("document"))


def damaged_wallet_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a poor network might deliver them: some of each kind of fault, by event number."""
    document = """CASE event_id % 23
        WHEN 1 THEN left(document, length(document) - 3)
        WHEN 3 THEN regexp_replace(document, '"amount_egp":[0-9.-]+', '"amount_egp":"12,5"')
        WHEN 5 THEN concat('[', document, ']')
        WHEN 7 THEN NULL
        WHEN 9 THEN concat(document, ' ', document)
        WHEN 11 THEN concat(document, ',', document)
        WHEN 13 THEN replace(document, '"_id"', '"id"')
        WHEN 15 THEN replace(document, '"event_ts":"', '"event_ts":"about ')
        WHEN 17 THEN concat('ERROR ', event_id)
        ELSE document END"""
    return wallet_documents(spark, sf_dir).selectExpr("event_id", f"{document} AS document")


def wallet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_documents(wallet_documents(spark, sf_dir), "document")


def atm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(
        load(spark, sf_dir, "lineitem"),
        "atm_sessions",
        atm_id="if(l_suppkey % 20 = 19, NULL, concat('ATM', l_suppkey))",
        session_date="l_shipdate",
        session_id="concat(l_orderkey, '-', l_linenumber)",
        session_ts="l_shipdate + make_dt_interval(0, 0, 0, l_orderkey % 86400)",
        card_token="if(l_partkey % 23 = 0, NULL, concat('tok_', l_partkey % 1000))",
        issuing_bank_id="if(l_partkey % 31 = 0, NULL, concat('BNK', l_partkey % 25))",
        txn_type="CASE l_returnflag WHEN 'R' THEN 'reversal' WHEN 'A' THEN 'Withdrawal' END",
        amount_egp="l_extendedprice",
        currency_code="if(l_partkey % 7 = 0, NULL, 'EGP')",
        response_code="if(l_partkey % 29 = 0, NULL, if(l_linestatus = 'F', '00', '51'))",
        status="""CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'failed'
                       WHEN l_returnflag = 'R' THEN 'rejected'
                       WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Declined'
                       WHEN l_partkey % 19 = 0 THEN NULL ELSE 'approved' END""",
        atm_location="concat('LOC', l_suppkey % 7)",
        governorate="concat('GOV', l_suppkey % 5)",
        network_id="if(l_linenumber % 2 = 0, '123', 'SHARED')",
        processing_ms="if(l_partkey % 17 = 0, NULL, l_quantity * 40)",
        error_code="if(l_linestatus = 'O', 'E51', NULL)",
        created_at="l_shipdate",
        updated_at="l_shipdate + make_dt_interval(0, l_linenumber)",
    )


BRONZE: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ach": ach,
    "meeza": meeza,
    "ipn": ipn,
    "wallet": wallet,
    "atm": atm,
}

# Rails that are a projection of one stored table: reading them again costs a scan, no join and no parsing of documents.
CHEAP_TO_READ = ("meeza", "ipn", "atm")

# Arrival numbers: an ordinary event's is its day number times ``SEQ_PER_DAY`` plus its cents, so two
# events of a key do not share one. Closing events come after all of them.
SEQ_PER_DAY = 100_000_000
DELETE_SEQ, REINSERT_SEQ = 10_000_000_000_000, 20_000_000_000_000


def changelog(rows: DataFrame, keys: tuple[str, ...], event_time: str, order_number: str) -> DataFrame:
    """A change stream over ``rows``: every row an event, then deletes, then some re-inserts.

    ``seq`` comes from the row's own event time, so no global order is computed. A key whose order number
    is a multiple of 17 ends with a delete; a multiple of 34 is inserted again after it.
    """
    days = F.unix_date(F.col(event_time).cast("date")).cast("bigint")
    cents = F.coalesce(F.col("amount_egp") * 100, F.lit(0)).cast("bigint")
    arrival = days * SEQ_PER_DAY + cents
    numbered = rows.withColumn("_order", F.expr(order_number).cast("bigint"))
    # one pass gives a row's event and its re-insert; a filter on the event time still reaches the scan
    turns = F.when(F.col("_order") % 34 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    again = F.col("_again")
    written = numbered.withColumn("_again", F.explode(turns)).select(
        *rows.columns,
        F.when(again, "c").when(days % 3 == 0, "u").otherwise("c").alias("op"),
        F.when(again, F.lit(REINSERT_SEQ).cast("bigint") + arrival).otherwise(arrival).alias("seq"),
    )
    deletes = numbered.filter(F.col("_order") % 17 == 0).select(
        [F.col(c) if c in keys else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]
        + [F.lit("d").alias("op"), F.lit(DELETE_SEQ).cast("bigint").alias("seq")]
    )
    return written.unionByName(deletes)


def ach_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog(ach(spark, sf_dir), ("txn_id",), "created_at", "substring_index(txn_id, '-', 1)")


def atm_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog(atm(spark, sf_dir), ("atm_id", "session_date", "session_id"), "updated_at", "substring_index(session_id, '-', 1)")


def damaged_ach_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transfer topic with values cut off, amounts written with a comma, and keys cut off, by offset."""
    return encode(ach_changelog(spark, sf_dir), ACH).selectExpr(
        "if(offset % 29 = 3, left(key, length(key) - 1), key) AS key",
        """CASE offset % 29 WHEN 1 THEN left(value, length(value) - 1)
                WHEN 2 THEN regexp_replace(value, '"amount_egp":[0-9.-]+', '"amount_egp":"12,5"') ELSE value END AS value""",
        "topic",
        "offset",
    )


# ---- Lineage events -----------------------------------------------------------------------------------


def lineage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lineage event (JSON) per event row, with 0 to 3 inputs and 0 to 2 outputs."""
    event_type = """CASE event_type WHEN 'purchase' THEN 'COMPLETE' WHEN 'signup' THEN 'COMPLETE'
                         WHEN 'view' THEN 'START' WHEN 'error' THEN 'FAIL' ELSE 'OTHER' END"""
    run = "named_struct('runId', if(number = 99, NULL, concat('run-', user_id)))"
    inputs = """slice(array(
        named_struct('namespace', 'kafka://broker', 'name', concat('public.t', number % 5)),
        named_struct('namespace', 'iceberg://cat', 'name', concat('bronze.t', number % 7)),
        named_struct('namespace', 'postgresql://db', 'name', concat('public.src.t', number % 3))), 1, CAST(number % 4 AS INT))"""
    outputs = """slice(array(
        named_struct('namespace', 'iceberg://cat', 'name', concat('silver.t', number % 4)),
        named_struct('namespace', 'ftp://drop', 'name', concat('out.t', number % 2))), 1, CAST(number % 3 AS INT))"""
    return events(spark, sf_dir).selectExpr(
        f"""to_json(named_struct('eventType', {event_type}, 'run', {run}, 'job', named_struct('name', 'silver'),
                                 'inputs', {inputs}, 'outputs', {outputs})) AS value""",
        "ts AS event_time",
        "event_id",
    )


def damaged_lineage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = """CASE event_id % 19
        WHEN 2 THEN left(value, length(value) - 2)
        WHEN 4 THEN regexp_replace(value, '"inputs":\\\\[[^\\\\]]*\\\\]', '"inputs":"none"')
        WHEN 6 THEN ''
        WHEN 8 THEN regexp_replace(value, '"run":\\\\{[^}]*\\\\}', '"run":7')
        ELSE value END"""
    return lineage_events(spark, sf_dir).selectExpr(f"{value} AS value", "event_time", "event_id")
