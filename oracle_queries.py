"""DuckDB SQL for the registered queries: the expected results, written down independently in SQL.

``bronze``, ``silver`` and mart texts are CTEs that later queries reuse; DuckDB evaluates them on the
driver's tables.
"""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

BRONZE = {
    "ach": """
        SELECT l_orderkey || '-' || l_linenumber AS txn_id,
               'B' || l_suppkey AS batch_id,
               CASE l_linenumber % 3 WHEN 0 THEN ' credit ' WHEN 1 THEN 'Debit' ELSE 'RETURN' END AS txn_type,
               ' bnk' || c_nationkey AS originating_bank_id,
               'Bnk' || s_nationkey || ' ' AS receiving_bank_id,
               'ACC' || o_custkey AS originator_account,
               'ACC' || l_suppkey AS receiver_account,
               CASE WHEN l_partkey % 97 <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount_egp,
               CASE WHEN l_partkey % 5 <> 0 THEN 'EGP' END AS currency_code,
               CASE WHEN l_returnflag = 'R' THEN ' returned ' WHEN l_returnflag = 'A' THEN 'Settled'
                    WHEN l_linestatus = 'F' THEN 'FAILED' ELSE 'pending' END AS txn_status,
               l_shipdate AS created_at,
               CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_shipdate AS DATE) END AS settlement_date
        FROM lineitem
        JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey
        JOIN supplier ON s_suppkey = l_suppkey""",
    "meeza": """
        SELECT 'A' || o_orderkey AS auth_id,
               CASE WHEN o_custkey % 29 <> 0 THEN 'tok_' || o_custkey END AS card_token,
               CASE WHEN o_orderkey % 31 <> 0 THEN 'M' || (o_custkey % 500) END AS merchant_id,
               CASE o_orderkey % 4 WHEN 0 THEN 'GROCERY' WHEN 1 THEN 'FUEL' WHEN 2 THEN 'TRAVEL' END AS merchant_category,
               CASE WHEN o_orderkey % 5 <> 0 THEN 'T' || (o_custkey % 97) END AS terminal_id,
               CASE WHEN o_orderkey % 9 = 0 THEN 'Refund' ELSE 'purchase' END AS txn_type,
               CASE o_orderpriority WHEN '1-URGENT' THEN ' pos' WHEN '2-HIGH' THEN 'ecommerce '
                    WHEN '3-MEDIUM' THEN 'Atm' WHEN '4-NOT SPECIFIED' THEN 'contactless' END AS channel,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount_egp,
               'EGP' AS currency_code,
               CASE o_orderkey % 6 WHEN 0 THEN '00' WHEN 1 THEN '05' WHEN 2 THEN '51' WHEN 3 THEN '14'
                    WHEN 5 THEN '00' END AS response_code,
               CASE WHEN o_custkey % 37 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'approved'
                    WHEN o_orderstatus = 'O' THEN ' Declined ' ELSE 'reversed' END AS auth_status,
               'BNK' || (o_custkey % 25) AS issuing_bank_id,
               CASE WHEN o_orderkey % 11 <> 0 THEN 'BNK' || (o_orderkey % 25) END AS acquiring_bank_id,
               CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 33 = 0 END AS is_international,
               o_orderdate + to_seconds(o_orderkey % 86400) AS auth_timestamp,
               CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + 1 END AS settlement_date
        FROM orders""",
    "ipn": f"""
        SELECT user_id || '-' || strftime(ts, '%Y%m%d%H') AS txn_id,
               ' PR' || event_id AS payment_ref,
               CASE WHEN user_id % 41 <> 0 THEN 'U' || user_id END AS sender_proxy,
               'R' || {K} AS receiver_proxy,
               ' bnk' || (user_id % 25) AS sender_bank_id,
               CASE WHEN {K} <> 7 THEN 'Bnk' || ({K} % 25) END AS receiver_bank_id,
               value AS amount_egp,
               CASE event_type WHEN 'purchase' THEN 'merchant' WHEN 'view' THEN ' bill ' WHEN 'click' THEN 'salary'
                    WHEN 'error' THEN 'p2p' END AS payment_purpose,
               CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'view' THEN ' Completed' WHEN 'error' THEN 'FAILED'
                    WHEN 'signup' THEN 'reversed' ELSE 'processing' END AS txn_status,
               CASE WHEN event_type = 'error' THEN ' timeout ' END AS failure_reason,
               CASE event_id % 4 WHEN 0 THEN 'instapay_app' WHEN 1 THEN ' Bank_App' WHEN 2 THEN 'USSD' END
                   AS initiation_channel,
               CASE WHEN event_id % 53 <> 0 THEN CAST(floor(value * 10) AS BIGINT) END AS processing_time_ms,
               ts AS initiated_at,
               CASE WHEN event_type <> 'click' THEN ts + INTERVAL 2 SECOND END AS completed_at
        FROM events""",
    "wallet": f"""
        SELECT 'W' || event_id AS _id,
               CASE WHEN {K} % 10 <> 0 THEN 'WLT' || {K} END AS wallet_id,
               CASE event_type WHEN 'purchase' THEN 'merchant_payment' WHEN 'view' THEN 'qr_payment'
                    WHEN 'click' THEN 'wallet_transfer' WHEN 'signup' THEN 'top_up' ELSE 'withdrawal' END AS event_type,
               CASE WHEN {K} % 13 <> 0 THEN CASE WHEN {K} % 2 = 0 THEN 'mobile_app' ELSE 'Ussd' END END AS channel,
               'BNK' || (user_id % 25) AS issuing_bank_id,
               CASE WHEN {K} <> 50 THEN CAST(value AS DECIMAL(18,2)) END AS amount_egp,
               CASE event_id % 5 WHEN 0 THEN 'completed' WHEN 1 THEN 'Completed' WHEN 2 THEN 'Failed'
                    WHEN 3 THEN 'pending' ELSE 'rejected' END AS status,
               ts AS event_ts
        FROM events""",
    "atm": """
        SELECT CASE WHEN l_suppkey % 20 <> 19 THEN 'ATM' || l_suppkey END AS atm_id,
               CAST(l_shipdate AS DATE) AS session_date,
               l_orderkey || '-' || l_linenumber AS session_id,
               l_shipdate + to_seconds(l_orderkey % 86400) AS session_ts,
               CASE WHEN l_partkey % 23 <> 0 THEN 'tok_' || (l_partkey % 1000) END AS card_token,
               CASE WHEN l_partkey % 31 <> 0 THEN 'BNK' || (l_partkey % 25) END AS issuing_bank_id,
               CASE l_returnflag WHEN 'R' THEN 'reversal' WHEN 'A' THEN 'Withdrawal' END AS txn_type,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_egp,
               CASE WHEN l_partkey % 7 <> 0 THEN 'EGP' END AS currency_code,
               CASE WHEN l_partkey % 29 <> 0 THEN CASE WHEN l_linestatus = 'F' THEN '00' ELSE '51' END END AS response_code,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'failed'
                    WHEN l_returnflag = 'R' THEN 'rejected'
                    WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Declined'
                    WHEN l_partkey % 19 = 0 THEN NULL ELSE 'approved' END AS status,
               'LOC' || (l_suppkey % 7) AS atm_location,
               'GOV' || (l_suppkey % 5) AS governorate,
               CASE WHEN l_linenumber % 2 = 0 THEN '123' ELSE 'SHARED' END AS network_id,
               CASE WHEN l_partkey % 17 <> 0 THEN CAST(l_quantity * 40 AS INTEGER) END AS processing_ms,
               CASE WHEN l_linestatus = 'O' THEN 'E51' END AS error_code,
               l_shipdate AS created_at,
               l_shipdate + to_hours(l_linenumber) AS updated_at
        FROM lineitem""",
}

# The order that decides between versions of a key: event time first, then every other column.
VERSION_ORDER = {
    "ach": "created_at batch_id txn_type originating_bank_id receiving_bank_id originator_account receiver_account "
    "amount_egp currency_code txn_status settlement_date",
    "meeza": "auth_timestamp card_token merchant_id merchant_category terminal_id txn_type channel amount_egp "
    "currency_code response_code auth_status issuing_bank_id acquiring_bank_id is_international settlement_date",
    "ipn": "initiated_at payment_ref sender_proxy receiver_proxy sender_bank_id receiver_bank_id amount_egp "
    "payment_purpose txn_status failure_reason initiation_channel processing_time_ms completed_at",
    "wallet": "event_ts wallet_id event_type channel issuing_bank_id amount_egp status",
    "atm": "updated_at session_date session_ts card_token issuing_bank_id txn_type amount_egp currency_code "
    "response_code status processing_ms created_at",
}
DEDUP_KEY = {"ach": "txn_id", "meeza": "auth_id", "ipn": "txn_id", "wallet": "_id", "atm": "atm_id, session_id"}
EVENT_TIME = {
    "ach": "created_at",
    "meeza": "auth_timestamp",
    "ipn": "initiated_at",
    "wallet": "event_ts",
    "atm": "updated_at",
}


def newest_first(columns: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in columns.split())


# The rules for the newest version of each key, rule by rule: codes are trimmed and put in capitals, gaps get defaults,
# then come the derived columns and new names. ``{latest}`` stands for those versions.
SILVER = {
    "ach": """
        WITH codes AS (
          SELECT * REPLACE (upper(trim(txn_type)) AS txn_type, upper(trim(txn_status)) AS txn_status,
                            upper(trim(originating_bank_id)) AS originating_bank_id,
                            upper(trim(receiving_bank_id)) AS receiving_bank_id) FROM ({latest})),
        gaps AS (SELECT * REPLACE (coalesce(currency_code, 'EGP') AS currency_code, coalesce(amount_egp, 0.00) AS amount_egp) FROM codes)
        SELECT * EXCLUDE (created_at), created_at AS source_created_at, CAST(created_at AS DATE) AS created_date FROM gaps""",
    "meeza": """
        WITH codes AS (
          SELECT * REPLACE (upper(txn_type) AS txn_type, upper(trim(auth_status)) AS auth_status, upper(trim(channel)) AS channel)
          FROM ({latest})),
        gaps AS (
          SELECT * REPLACE (ifnull(card_token, '') AS card_token, ifnull(terminal_id, '') AS terminal_id,
                            ifnull(acquiring_bank_id, '') AS acquiring_bank_id, ifnull(merchant_id, 'UNKNOWN') AS merchant_id,
                            ifnull(merchant_category, 'OTHER') AS merchant_category, ifnull(currency_code, 'EGP') AS currency_code,
                            ifnull(amount_egp, 0.00) AS amount_egp, ifnull(is_international, false) AS is_international)
          FROM codes),
        dated AS (SELECT *, CAST(auth_timestamp AS DATE) AS auth_date FROM gaps)
        SELECT * REPLACE (ifnull(settlement_date, auth_date) AS settlement_date),
               auth_status = 'APPROVED' OR response_code = '00' AS is_approved FROM dated""",
    "ipn": """
        WITH codes AS (
          SELECT * REPLACE (trim(payment_ref) AS payment_ref, trim(failure_reason) AS failure_reason,
                            upper(trim(sender_bank_id)) AS sender_bank_id, upper(trim(receiver_bank_id)) AS receiver_bank_id,
                            upper(trim(payment_purpose)) AS payment_purpose, upper(trim(txn_status)) AS txn_status,
                            upper(trim(initiation_channel)) AS initiation_channel) FROM ({latest})),
        gaps AS (
          SELECT * REPLACE (ifnull(payment_ref, '') AS payment_ref, ifnull(failure_reason, '') AS failure_reason,
                            ifnull(sender_bank_id, '') AS sender_bank_id, ifnull(receiver_bank_id, '') AS receiver_bank_id,
                            ifnull(sender_proxy, 'UNKNOWN') AS sender_proxy, ifnull(receiver_proxy, 'UNKNOWN') AS receiver_proxy,
                            ifnull(txn_status, 'UNKNOWN') AS txn_status, ifnull(initiation_channel, 'UNKNOWN') AS initiation_channel,
                            ifnull(payment_purpose, 'P2P') AS payment_purpose, ifnull(completed_at, initiated_at) AS completed_at,
                            ifnull(amount_egp, 0) AS amount_egp, ifnull(processing_time_ms, 0) AS processing_time_ms) FROM codes)
        SELECT *, CAST(initiated_at AS DATE) AS initiated_date, processing_time_ms <= 2000 AS met_sla FROM gaps""",
    "wallet": """
        WITH codes AS (
          SELECT * REPLACE (upper(event_type) AS event_type, upper(status) AS status, upper(channel) AS channel) FROM ({latest})),
        gaps AS (SELECT * REPLACE (ifnull(wallet_id, 'N/A') AS wallet_id, ifnull(amount_egp, 0.00) AS amount_egp) FROM codes)
        SELECT * EXCLUDE (_id, event_type, status, event_ts), _id AS document_id, event_type AS txn_type, status AS txn_status,
               event_ts AS event_timestamp, CAST(event_ts AS DATE) AS event_date FROM gaps""",
    "atm": """
        WITH codes AS (SELECT * REPLACE (upper(status) AS status, upper(txn_type) AS txn_type) FROM ({latest})),
        gaps AS (
          SELECT * REPLACE (ifnull(atm_id, 'UNKNOWN') AS atm_id, ifnull(session_id, 'UNKNOWN') AS session_id,
                            ifnull(status, 'UNKNOWN') AS status, ifnull(txn_type, 'UNKNOWN') AS txn_type,
                            ifnull(card_token, 'UNKNOWN') AS card_token, ifnull(response_code, 'UNKNOWN') AS response_code,
                            ifnull(issuing_bank_id, 'UNKNOWN') AS issuing_bank_id, ifnull(currency_code, 'EGP') AS currency_code,
                            ifnull(amount_egp, 0.00) AS amount_egp, ifnull(CAST(processing_ms AS BIGINT), 0) AS processing_ms,
                            ifnull(session_date, make_date(1970, 1, 1)) AS session_date, ifnull(session_ts, 'epoch') AS session_ts,
                            ifnull(created_at, 'epoch') AS created_at, ifnull(updated_at, 'epoch') AS updated_at) FROM codes)
        SELECT * EXCLUDE (status, session_ts, created_at, updated_at, atm_location, governorate, network_id, error_code),
               status AS txn_status, session_ts AS session_timestamp, created_at AS created_ts, updated_at AS updated_ts FROM gaps""",
}


def silver(rail: str, source: str) -> str:
    """The newest version of each key of ``source`` (a table or CTE name with the rail's bronze columns), cleansed."""
    first = "(completed_at IS NULL) ASC, " if rail == "ipn" else ""
    keep = "" if rail == "atm" else f"WHERE {DEDUP_KEY[rail]} IS NOT NULL"
    latest = f"""SELECT * FROM {source} {keep}
        QUALIFY row_number() OVER (PARTITION BY {DEDUP_KEY[rail]} ORDER BY {first}{newest_first(VERSION_ORDER[rail])}) = 1"""
    return SILVER[rail].format(latest=latest)


def with_(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes) + "\n"


B = {r: (f"b_{r}", sql) for r, sql in BRONZE.items()}
S = {r: (f"s_{r}", silver(r, f"b_{r}")) for r in BRONZE}
ALL_SILVER = [*B.values(), *S.values()]


def daily_volume(prefix: str = "s_") -> str:
    def rail(name, date, scheme, approved, failed):
        return f"""SELECT {date} AS report_date, '{scheme}' AS scheme, count(*) AS n,
                   sum(CAST(amount_egp AS DECIMAL(18,2))) AS total,
                   count(*) FILTER (WHERE {approved}) AS ok, count(*) FILTER (WHERE {failed}) AS bad
            FROM {prefix}{name} WHERE {date} IS NOT NULL GROUP BY 1"""

    branches = " UNION ALL ".join(
        [
            rail("ach", "settlement_date", "EG-ACH", "txn_status = 'SETTLED'", "txn_status IN ('FAILED', 'RETURNED')"),
            rail("meeza", "settlement_date", "MEEZA", "is_approved = TRUE", "is_approved = FALSE"),
            rail("ipn", "initiated_date", "IPN-INSTAPAY", "txn_status = 'COMPLETED'", "txn_status IN ('FAILED', 'REVERSED')"),
            rail("wallet", "event_date", "MEEZA-DIGITAL", "txn_status = 'COMPLETED'", "txn_status IN ('FAILED', 'REJECTED')"),
            rail(
                "atm", "session_date", "123-ATM-NETWORK", "txn_status = 'APPROVED'",
                "txn_status IN ('FAILED', 'DECLINED', 'REJECTED')",
            ),
        ]
    )
    return f"""
        SELECT report_date, scheme, CAST(n AS BIGINT) AS txn_count, CAST(total AS DECIMAL(38,2)) AS total_amount_egp,
               CAST(ok AS BIGINT) AS approved_count, CAST(bad AS BIGINT) AS failed_count,
               CAST(round(CAST(total AS DOUBLE) / nullif(n, 0), 2) AS DECIMAL(38,2)) AS avg_txn_amount_egp
        FROM ({branches})"""


def scheme_performance(prefix: str = "s_") -> str:
    def rail(name, date, scheme, channel, approved, latency):
        return f"""SELECT {date} AS report_date, '{scheme}' AS scheme, {channel} AS channel,
                   CAST(count(*) AS BIGINT) AS txn_volume,
                   CAST(round(count(*) FILTER (WHERE {approved}) * 100.0::DOUBLE / count(*), 3) AS DECIMAL(6,3)) AS approval_rate_pct,
                   {latency} AS avg_processing_ms
            FROM {prefix}{name} WHERE {date} IS NOT NULL GROUP BY 1, 2, 3"""

    return " UNION ALL ".join(
        [
            rail("meeza", "settlement_date", "MEEZA", "channel", "is_approved = TRUE", "CAST(0 AS DOUBLE)"),
            rail(
                "ipn", "initiated_date", "IPN-INSTAPAY", "initiation_channel", "txn_status = 'COMPLETED'",
                "round(avg(CAST(processing_time_ms AS DOUBLE)), 0)",
            ),
            rail("wallet", "event_date", "MEEZA-DIGITAL", "channel", "txn_status = 'COMPLETED'", "CAST(0 AS DOUBLE)"),
            rail(
                "atm", "session_date", "123-ATM-NETWORK", "'ATM_TERMINAL'", "txn_status = 'APPROVED'",
                "round(avg(CAST(processing_ms AS DOUBLE)), 0)",
            ),
        ]
    )


def settlement_summary(source: str = "s_ach") -> str:
    return f"""
        SELECT settlement_date, originating_bank_id, receiving_bank_id,
               CAST(count(*) FILTER (WHERE txn_status = 'SETTLED') AS BIGINT) AS settled_count,
               CAST(count(*) FILTER (WHERE txn_status = 'FAILED') AS BIGINT) AS failed_count,
               CAST(count(*) FILTER (WHERE txn_status = 'RETURNED') AS BIGINT) AS returned_count,
               CAST(sum(amount_egp) FILTER (WHERE txn_status = 'SETTLED') AS DECIMAL(38,2)) AS net_settled_egp,
               CAST(sum(amount_egp) FILTER (WHERE txn_status = 'FAILED') AS DECIMAL(38,2)) AS failed_amount_egp,
               CAST(round(count(*) FILTER (WHERE txn_status = 'SETTLED') * 100.0::DOUBLE / count(*), 2) AS DECIMAL(6,2))
                   AS settlement_rate_pct
        FROM {source} WHERE settlement_date IS NOT NULL GROUP BY 1, 2, 3"""


VOLUME = ("volume", daily_volume())
PERFORMANCE = ("performance", scheme_performance())
SETTLEMENT = ("settlement", settlement_summary())
MARTS = with_(*ALL_SILVER, VOLUME, PERFORMANCE, SETTLEMENT)


def bigint(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


# ---- Bronze -------------------------------------------------------------------------------------------

ACH_COLUMNS = (
    "txn_id batch_id txn_type originating_bank_id receiving_bank_id originator_account receiver_account amount_egp "
    "currency_code txn_status created_at settlement_date"
).split()
ATM_COLUMNS = (
    "atm_id session_date session_id session_ts card_token issuing_bank_id txn_type amount_egp currency_code "
    "response_code status atm_location governorate network_id processing_ms error_code created_at updated_at"
).split()


def changelog(source: str, columns: list[str], keys: list[str], event_time: str, order_number: str) -> str:
    nulls = ", ".join(c if c in keys else f"NULL AS {c}" for c in columns)
    names = ", ".join(columns)
    days = f"CAST(date_diff('day', DATE '1970-01-01', CAST({event_time} AS DATE)) AS BIGINT)"
    seq = f"{days} * 100000000 + CAST(coalesce(amount_egp, 0) * 100 AS BIGINT)"
    return f"""
        SELECT {names}, CASE WHEN {days} % 3 = 0 THEN 'u' ELSE 'c' END AS op, {seq} AS seq FROM {source}
        UNION ALL SELECT {nulls}, 'd', 10000000000000 FROM {source} WHERE {order_number} % 17 = 0
        UNION ALL SELECT {names}, 'c', 20000000000000 + {seq} FROM {source} WHERE {order_number} % 34 = 0"""


ACH_LOG = ("ach_log", changelog("b_ach", ACH_COLUMNS, ["txn_id"], "created_at", "CAST(split_part(txn_id, '-', 1) AS BIGINT)"))
ATM_LOG = (
    "atm_log",
    changelog(
        "b_atm", ATM_COLUMNS, ["atm_id", "session_date", "session_id"], "updated_at",
        "CAST(split_part(session_id, '-', 1) AS BIGINT)",
    ),
)


def latest_state(log: str, columns: list[str], keys: list[str]) -> str:
    rest = [c for c in columns if c not in keys]
    return f"""
        SELECT {", ".join(columns)}
        FROM (SELECT *, row_number() OVER (PARTITION BY {", ".join(keys)}
                                           ORDER BY {newest_first(" ".join(["seq", *rest]))}) AS rn FROM {log})
        WHERE rn = 1 AND op <> 'd'"""


def bronze_sql() -> dict[str, str]:
    ach = with_(B["ach"], ACH_LOG)
    state = latest_state("ach_log", ACH_COLUMNS, ["txn_id"])
    order = "(op = 'u') DESC, " + newest_first(
        "created_at batch_id txn_type originating_bank_id receiving_bank_id originator_account receiver_account "
        "amount_egp currency_code txn_status settlement_date op seq"
    )
    return {
        "bronze_latest_state": ach + state,
        "bronze_composite_key": with_(B["atm"], ATM_LOG)
        + latest_state("atm_log", ATM_COLUMNS, ["atm_id", "session_date", "session_id"]),
        "bronze_state_since": ach + f"SELECT * FROM ({state}) WHERE created_at > TIMESTAMP '2001-01-01'",
        "brz4_legacy_order": ach
        + f"""SELECT * EXCLUDE (rn) FROM
              (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY {order}) AS rn FROM ach_log) WHERE rn = 1""",
        "brz5_not_deleted": ach + "SELECT * FROM ach_log WHERE op <> 'd'",
        "src2_documents": BRONZE["wallet"],
        "src2_fitting": BRONZE["wallet"] + f" WHERE event_id % 23 NOT IN (1, 5, 7, 9, 11, 13, 15, 17) AND (event_id % 23 <> 3 OR {K} = 50)",
        "src2_rejects": f"""
            SELECT event_id, reason AS reject_reason, fields
            FROM events JOIN (VALUES (1, 'malformed', ''), (3, 'bad value', 'amount_egp'), (5, 'not an object', ''), (7, 'no document', ''),
                                     (9, 'malformed', ''), (11, 'not an object', ''), (13, 'missing', '_id'), (15, 'bad value', 'event_ts'),
                                     (17, 'malformed', '')) AS faults(rest, reason, fields) ON event_id % 23 = rest
            WHERE rest <> 3 OR {K} <> 50""",
        "src4_topic": ach + state,
        "src4_rejects": ach
        + """, faulty AS (SELECT '{"txn_id":"' || txn_id || '"' AS opening, op, seq, amount_egp FROM ach_log)
             SELECT opening AS record_key, seq, 'malformed' AS reject_reason, '' AS fields FROM faulty WHERE seq % 29 = 3
             UNION ALL SELECT opening || '}', seq, 'malformed', '' FROM faulty WHERE seq % 29 = 1 AND op <> 'd'
             UNION ALL SELECT opening || '}', seq, 'bad value', 'amount_egp' FROM faulty
             WHERE seq % 29 = 2 AND op <> 'd' AND amount_egp IS NOT NULL""",
        "snk2_stream_upsert": ach + state,
        "snk3_targets": BRONZE["ach"],
    }


# ---- Silver -------------------------------------------------------------------------------------------

FIRST_LOAD = {"ipn": "2024-01-20 12:00:00", "wallet": "2024-01-20 12:00:00", "ach": "2001-06-01 12:00:00"}


def first_load(rail: str) -> tuple[str, str]:
    where = f" WHERE {EVENT_TIME[rail]} < TIMESTAMP '{FIRST_LOAD[rail]}'" if rail in FIRST_LOAD else ""
    return f"b1_{rail}", f"SELECT * FROM b_{rail}{where}"


def target(rail: str) -> tuple[str, str]:
    return f"t_{rail}", silver(rail, f"b1_{rail}")


def increment(rail: str, high_water: str) -> list[tuple[str, str]]:
    rows = f"""SELECT * FROM b_{rail} WHERE {EVENT_TIME[rail]} >
               (SELECT coalesce(max({high_water}), TIMESTAMP '1970-01-01') - INTERVAL 1 HOUR FROM t_{rail})"""
    return [(f"r_{rail}", rows), (f"n_{rail}", silver(rail, f"r_{rail}"))]


def silver_sql() -> dict[str, str]:
    out = {f"silver_{rail}": with_(B[rail], S[rail]) + f"SELECT * FROM s_{rail}" for rail in BRONZE}

    def dedup(rail: str, first: str = "", drop: str = "") -> str:
        return with_(B[rail]) + f"""
            SELECT * EXCLUDE (rn{drop}) FROM
            (SELECT *, row_number() OVER (PARTITION BY {DEDUP_KEY[rail]}
                                          ORDER BY {first}{newest_first(VERSION_ORDER[rail])}) AS rn FROM b_{rail})
            WHERE rn = 1"""

    ipn = with_(B["ipn"], first_load("ipn"), target("ipn"), *increment("ipn", "initiated_at"))
    ach = with_(B["ach"], first_load("ach"), target("ach"), *increment("ach", "source_created_at"))
    return out | {
        "ded1_latest": dedup("ach"),
        "ded2_completed_first": dedup("ipn", first="(completed_at IS NULL) ASC, "),
        "ded3_composite_key": dedup("atm", drop=", atm_location, governorate, network_id, error_code"),
        "inc1_back_window": ipn + "SELECT * FROM r_ipn",
        "inc2_strict": ipn + "SELECT * FROM b_ipn WHERE initiated_at > (SELECT max(initiated_at) FROM t_ipn)",
        "mrg1_upsert": ipn
        + """SELECT * FROM t_ipn WHERE txn_id NOT IN (SELECT txn_id FROM n_ipn)
             UNION ALL SELECT * FROM n_ipn""",
        "mrg1_partition_move": ach
        + """SELECT event_day, CAST(sum(hit) AS BIGINT) AS replaced, CAST(sum(keep) AS BIGINT) AS remaining,
                    CAST(sum(new) AS BIGINT) AS arriving, sum(keep) = 0 AND sum(new) = 0 AS emptied
             FROM (SELECT created_date AS event_day, CASE WHEN txn_id IN (SELECT txn_id FROM n_ach) THEN 1 ELSE 0 END AS hit,
                          CASE WHEN txn_id IN (SELECT txn_id FROM n_ach) THEN 0 ELSE 1 END AS keep, 0 AS new FROM t_ach
                   UNION ALL SELECT created_date, 0, 0, 1 FROM n_ach)
             GROUP BY 1 HAVING sum(hit) > 0 OR sum(new) > 0""",
        "mrg2_new_column": ipn
        + """SELECT txn_id, amount_egp, initiated_at, CAST(NULL AS BOOLEAN) AS met_sla FROM t_ipn
             WHERE txn_id NOT IN (SELECT txn_id FROM n_ipn)
             UNION ALL SELECT txn_id, amount_egp, initiated_at, met_sla FROM n_ipn""",
        "pii1_hash": """
            SELECT 'customer' AS source, c_custkey AS id, upper(sha256(c_name)) AS digest FROM customer
            UNION ALL SELECT 'document', doc_id, upper(sha256(text)) FROM documents""",
    }


# ---- Gold and serving ---------------------------------------------------------------------------------


def gold_sql() -> dict[str, str]:
    return {
        "gold_daily_volume": with_(*ALL_SILVER) + daily_volume(),
        "gold_scheme_performance": with_(*ALL_SILVER) + scheme_performance(),
        "gold_settlement_summary": with_(B["ach"], S["ach"]) + settlement_summary(),
    }


SERVED_VOLUME = """
    SELECT report_date, scheme, txn_count, CAST(total_amount_egp AS DECIMAL(18,2)) AS total_amount_egp, approved_count,
           failed_count, CAST(avg_txn_amount_egp AS DECIMAL(18,2)) AS avg_txn_amount_egp FROM {0}"""
SERVED_PERFORMANCE = (
    "SELECT report_date, scheme, channel, approval_rate_pct, avg_processing_ms, txn_volume FROM {0}"
)
SERVED_SETTLEMENT = """
    SELECT settlement_date, originating_bank_id, receiving_bank_id, settled_count, failed_count, returned_count,
           CAST(net_settled_egp AS DECIMAL(18,2)) AS net_settled_egp,
           CAST(failed_amount_egp AS DECIMAL(18,2)) AS failed_amount_egp, settlement_rate_pct FROM {0}"""


def serving_sql() -> dict[str, str]:
    firsts = [first_load(r) for r in BRONZE] + [target(r) for r in BRONZE]

    def two_runs(first: str, second: str, shape: str, keys: list[str], as_of: str) -> str:
        same = " AND ".join(f"w.{k} IS NOT DISTINCT FROM d.{k}" for k in keys)
        return with_(
            *ALL_SILVER,
            *firsts,
            ("m1", first),
            ("m2", second),
            ("day1", shape.format("m1")),
            ("win", shape.format("m2") + f" WHERE {keys[0]} >= DATE '{as_of}' - INTERVAL 7 DAY"),
        ) + f"""SELECT * FROM day1 d WHERE NOT EXISTS (SELECT 1 FROM win w WHERE {same})
                UNION ALL SELECT * FROM win"""

    return {
        "serving_daily_volume": two_runs(
            daily_volume("t_"), daily_volume(), SERVED_VOLUME, ["report_date", "scheme"], "2024-01-28"
        ),
        "serving_scheme_performance": two_runs(
            scheme_performance("t_"), scheme_performance(), SERVED_PERFORMANCE, ["report_date", "scheme", "channel"],
            "2024-01-28",
        ),
        "serving_settlement": two_runs(
            settlement_summary("t_ach"), settlement_summary(), SERVED_SETTLEMENT,
            ["settlement_date", "originating_bank_id", "receiving_bank_id"], "2001-06-09",
        ),
    }


# ---- Semantic layer -----------------------------------------------------------------------------------

# metric -> (mart, expression)
SIMPLE = {
    "total_transactions": ("volume", bigint("sum(txn_count)")),
    "total_payment_value_egp": ("volume", "CAST(sum(total_amount_egp) AS DECIMAL(38,2))"),
    "total_approved_transactions": ("volume", bigint("sum(approved_count)")),
    "total_failed_transactions": ("volume", bigint("sum(failed_count)")),
    "total_settled_transactions": ("settlement", bigint("sum(settled_count)")),
    "total_failed_settlement_transactions": ("settlement", bigint("sum(failed_count)")),
    "total_returned_transactions": ("settlement", bigint("sum(returned_count)")),
    "total_attempted_settlements": ("settlement", bigint("sum(settled_count + failed_count + returned_count)")),
    "net_settlement_value_egp": ("settlement", "CAST(sum(net_settled_egp) AS DECIMAL(38,2))"),
    "failed_settlement_value_egp": ("settlement", "CAST(sum(failed_amount_egp) AS DECIMAL(38,2))"),
    "total_channel_transaction_volume": ("performance", bigint("sum(txn_volume)")),
    # mean of DECIMAL(6,3), kept at seven decimals
    "avg_scheme_approval_rate_pct": (
        "performance",
        "CAST(CAST((CAST(sum(approval_rate_pct) * 1000 AS HUGEINT) * 20000 + count(approval_rate_pct)) "
        "// (2 * count(approval_rate_pct)) AS DECIMAL(18,0)) * CAST(0.0000001 AS DECIMAL(8,7)) AS DECIMAL(10,7))",
    ),
    "avg_payment_processing_latency_ms": ("performance", "avg(avg_processing_ms)"),
}
RATIO = {
    "payment_approval_rate": ("total_approved_transactions", "total_transactions"),
    "payment_failure_rate": ("total_failed_transactions", "total_transactions"),
    "avg_transaction_value_egp": ("total_payment_value_egp", "total_transactions"),
    "settlement_success_rate": ("total_settled_transactions", "total_attempted_settlements"),
    "settlement_return_rate": ("total_returned_transactions", "total_attempted_settlements"),
}


def metric(name: str) -> tuple[str, str]:
    if name in SIMPLE:
        return SIMPLE[name]
    numerator, denominator = RATIO[name]
    mart, top = SIMPLE[numerator]
    return mart, f"CAST({top} AS DOUBLE) / nullif(CAST({SIMPLE[denominator][1]} AS DOUBLE), 0)"


def metrics(names: list[str], groups: dict[str, str] | None = None, where: str = "") -> str:
    groups = groups or {}
    columns = [f"{e} AS {g}" for g, e in groups.items()] + [f"{metric(n)[1]} AS {n}" for n in names]
    by = " GROUP BY ALL" if groups else ""
    return MARTS + f"SELECT {', '.join(columns)} FROM {metric(names[0])[0]}{where}{by}"


VOLUME_METRICS = [n for n in [*SIMPLE, *RATIO] if metric(n)[0] == "volume"]
CHANNEL_METRICS = [n for n in [*SIMPLE, *RATIO] if metric(n)[0] == "performance"]
SETTLEMENT_METRICS = [n for n in [*SIMPLE, *RATIO] if metric(n)[0] == "settlement"]


def semantic_sql() -> dict[str, str]:
    out = {f"metric_{n}": metrics([n]) for n in [*SIMPLE, *RATIO]}
    scheme = {"scheme": "scheme"}

    def year(mart: str, date: str, value: str, name: str) -> str:
        return f"SELECT CAST(date_trunc('year', {date}) AS DATE) AS y, {value} AS {name} FROM {mart} GROUP BY 1"

    return out | {
        "time_spine": MARTS
        + """SELECT CAST(d AS DATE) AS date_day, CAST(coalesce(n, 0) AS BIGINT) AS total_transactions
             FROM generate_series((SELECT least(DATE '2020-01-01', min(report_date)) FROM volume),
                                  (SELECT greatest(DATE '2030-12-31', max(report_date)) FROM volume), INTERVAL 1 DAY) AS g(d)
             LEFT JOIN (SELECT report_date, sum(txn_count) AS n FROM volume GROUP BY 1) ON report_date = d""",
        "sem3_entity_key": MARTS
        + """SELECT CAST(report_date AS VARCHAR) || '||' || scheme || '||' || channel AS entity_key, txn_volume
             FROM performance""",
        "metrics_by_scheme": metrics(VOLUME_METRICS, scheme),
        "metrics_by_scheme_month": metrics(
            VOLUME_METRICS, scheme | {"report_date__month": "CAST(date_trunc('month', report_date) AS DATE)"}
        ),
        "metrics_by_channel": metrics(CHANNEL_METRICS, scheme | {"channel": "channel"}),
        "metrics_by_bank_pair": metrics(
            SETTLEMENT_METRICS,
            {"originating_bank_id": "originating_bank_id", "receiving_bank_id": "receiving_bank_id"},
        ),
        "metrics_across_marts": MARTS
        + f"""SELECT y AS metric_time__year, max(a) AS total_transactions, max(b) AS total_channel_transaction_volume,
                     max(c) AS total_settled_transactions
              FROM ({year("volume", "report_date", bigint("sum(txn_count)"), "a")}) FULL JOIN
                   ({year("performance", "report_date", bigint("sum(txn_volume)"), "b")}) USING (y) FULL JOIN
                   ({year("settlement", "settlement_date", bigint("sum(settled_count)"), "c")}) USING (y)
              GROUP BY 1""",
        "metrics_from_start": metrics(
            VOLUME_METRICS, scheme, " WHERE report_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"
        ),
        "metric_approval_rate_by_scheme_week": metrics(
            ["payment_approval_rate"],
            scheme | {"report_date__week": "CAST(date_trunc('week', report_date) AS DATE)"},
        ),
        "metric_volume_weighted_rate": MARTS
        + """SELECT scheme, CAST(sum(CAST(approval_rate_pct AS DECIMAL(18,3)) * txn_volume) AS DOUBLE)
                            / nullif(CAST(sum(txn_volume) AS DOUBLE), 0) AS volume_weighted_approval_rate_pct
             FROM performance GROUP BY 1""",
        "metric_settlement_by_bank": metrics(
            ["net_settlement_value_egp"], {"originating_bank_id": "originating_bank_id"}
        ),
    }


# ---- Quality, audits, telemetry -----------------------------------------------------------------------

SCHEMES = "'EG-ACH', 'MEEZA', 'IPN-INSTAPAY', 'MEEZA-DIGITAL', '123-ATM-NETWORK'"
# table -> where it is found in the CTEs
SOURCES = {
    "ach_transactions": "b_ach",
    "meeza_authorisations": "b_meeza",
    "ipn_transactions": "b_ipn",
    "meeza_digital_wallet_events": "b_wallet",
    "atm_sessions": "b_atm",
    "stg_ach_transactions": "s_ach",
    "stg_meeza_authorisations": "s_meeza",
    "stg_ipn_transactions": "s_ipn",
    "stg_meeza_digital_wallet": "s_wallet",
    "stg_atm_sessions": "s_atm",
    "mart_daily_txn_volume": "volume",
    "mart_scheme_performance": "performance",
    "mart_settlement_summary": "settlement",
    "daily_txn_volume": "volume",
    "scheme_performance": "performance",
    "settlement_summary": "settlement",
}
NOT_NULL = {
    "ach_transactions": "txn_id amount_egp",
    "meeza_authorisations": "auth_id",
    "ipn_transactions": "txn_id",
    "meeza_digital_wallet_events": "_id",
    "atm_sessions": "atm_id session_id",
    "stg_ach_transactions": "txn_id amount_egp settlement_date originating_bank_id source_created_at",
    "stg_meeza_authorisations": "auth_id is_approved amount_egp auth_timestamp",
    "stg_ipn_transactions": "txn_id payment_ref met_sla initiated_at",
    "stg_meeza_digital_wallet": "document_id amount_egp event_timestamp",
    "stg_atm_sessions": "session_id atm_id amount_egp updated_ts",
    "mart_daily_txn_volume": "report_date scheme txn_count total_amount_egp approved_count failed_count",
    "mart_scheme_performance": "report_date scheme channel",
    "mart_settlement_summary": "settlement_date originating_bank_id receiving_bank_id",
    "daily_txn_volume": "report_date scheme txn_count refreshed_at",
    "scheme_performance": "report_date scheme channel approval_rate_pct refreshed_at",
    "settlement_summary": "settlement_date originating_bank_id receiving_bank_id refreshed_at",
}
UNIQUE = {
    "stg_ach_transactions": "txn_id",
    "stg_meeza_authorisations": "auth_id",
    "stg_ipn_transactions": "txn_id",
    "stg_meeza_digital_wallet": "document_id",
}
ACCEPTED = [
    ("stg_ach_transactions", "txn_type", "'CREDIT', 'DEBIT', 'RETURN'"),
    ("stg_ach_transactions", "txn_status", "'PENDING', 'SETTLED', 'RETURNED', 'FAILED'"),
    ("stg_meeza_authorisations", "auth_status", "'APPROVED', 'DECLINED', 'REVERSED'"),
    ("stg_meeza_authorisations", "channel", "'POS', 'ECOMMERCE', 'ATM', 'CONTACTLESS'"),
    ("stg_ipn_transactions", "txn_status", "'COMPLETED', 'FAILED', 'REVERSED', 'PROCESSING'"),
    ("mart_daily_txn_volume", "scheme", SCHEMES),
    ("mart_scheme_performance", "scheme", SCHEMES),
    ("daily_txn_volume", "scheme", SCHEMES),
]
RANGES = [
    ("stg_ach_transactions", "amount_egp", "> 0"),
    ("stg_meeza_authorisations", "amount_egp", "> 0"),
    ("stg_ipn_transactions", "processing_time_ms", ">= 0"),
    ("stg_meeza_digital_wallet", "amount_egp", ">= 0"),
    ("stg_atm_sessions", "amount_egp", ">= 0"),
    ("mart_daily_txn_volume", "txn_count", ">= 0"),
    ("mart_daily_txn_volume", "total_amount_egp", ">= 0"),
    ("mart_daily_txn_volume", "approved_count", ">= 0"),
    ("mart_daily_txn_volume", "failed_count", ">= 0"),
    ("mart_daily_txn_volume", "avg_txn_amount_egp", ">= 0"),
    ("mart_scheme_performance", "txn_volume", ">= 0"),
    ("mart_scheme_performance", "approval_rate_pct", "BETWEEN 0 AND 100"),
    ("mart_scheme_performance", "avg_processing_ms", ">= 0"),
    ("mart_settlement_summary", "settlement_rate_pct", "BETWEEN 0 AND 100"),
]


def check(table: str, column: str, kind: str, violations: str, source: str | None = None) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS check_name, 'block' AS severity,
               CAST({violations} AS BIGINT) AS violations FROM {source or SOURCES[table]}"""


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


AS_OF = "TIMESTAMP '2024-01-31 03:00:00'"


def quality_sql() -> dict[str, str]:
    nulls = []
    for table, columns in NOT_NULL.items():
        for c in columns.split():
            broken = "0" if c == "refreshed_at" else f"count(*) FILTER (WHERE {c} IS NULL)"
            source = "(SELECT 1)" if c == "refreshed_at" else None
            nulls.append(check(table, c, "not_null", broken, source))
    duplicates = [
        check(t, c, "unique", "count(*)", f"(SELECT {c} FROM {SOURCES[t]} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        for t, c in UNIQUE.items()
    ]
    accepted = [check(t, c, "accepted_values", f"count(*) FILTER (WHERE {c} NOT IN ({v}))") for t, c, v in ACCEPTED]
    ranges = [check(t, c, "accepted_range", f"count(*) FILTER (WHERE NOT ({c} {r}))") for t, c, r in RANGES]

    events = union(
        [
            f"SELECT '{t}' AS table_name, count(*) AS row_count, max({EVENT_TIME[r]}) AS last_event FROM b_{r}"
            for t, r in zip(SOURCES, BRONZE)
        ]
    )
    last = with_(*B.values(), ("last", events), ("lag", f"SELECT *, epoch_us({AS_OF}) - epoch_us(last_event) AS us FROM last"))
    status = """CASE WHEN row_count = 0 THEN 'EMPTY' WHEN last_event IS NULL THEN 'NULL_TIMESTAMP'
                     WHEN us <= 21600000000 THEN 'FRESH' WHEN us > 86400000000 THEN 'HISTORICAL' ELSE 'STALE' END"""
    return {
        "dq1_not_null": MARTS + union(nulls),
        "dq2_unique": MARTS + union(duplicates),
        "dq3_accepted_values": MARTS + union(accepted),
        "dq4_accepted_range": MARTS + union(ranges),
        "agg9_duplicates": with_(B["ach"])
        + "SELECT txn_id, CAST(count(*) AS BIGINT) AS occurrences FROM b_ach WHERE txn_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        "frs1_gate": last
        + f"""SELECT table_name, CAST(row_count AS BIGINT) AS row_count, last_event,
                     CAST(us AS DOUBLE) / 3600000000.0::DOUBLE AS lag_hours, {status} AS status,
                     CASE {status} WHEN 'FRESH' THEN 'pass' WHEN 'HISTORICAL' THEN 'warn' ELSE 'fail' END AS outcome
              FROM lag""",
        "frs2_source": last
        + """SELECT table_name, last_event,
                    CASE WHEN last_event IS NULL OR us > 86400000000 THEN 'error' WHEN us > 7200000000 THEN 'warn'
                         ELSE 'pass' END AS status FROM lag""",
        "frs3_lag_minutes": last
        + f"""SELECT table_name, last_event,
                     CAST(date_sub('second', last_event, {AS_OF}) AS DOUBLE) / 60.0::DOUBLE AS lag_min FROM last""",
    }


TOPICS = {
    "ach": "public.ach_transactions",
    "meeza": "public.meeza_authorisations",
    "ipn": "public.ipn_transactions",
    "wallet": "meeza_digital.wallet_events",
    "atm": "dbo.atm_sessions",
}
BRONZE_TABLE = dict(zip(BRONZE, SOURCES))
SILVER_TABLE = dict(zip(BRONZE, list(SOURCES)[5:10]))
HIGH_WATER = {
    "ach": "source_created_at",
    "meeza": "auth_timestamp",
    "ipn": "initiated_at",
    "wallet": "event_timestamp",
    "atm": "updated_ts",
}


def audit_sql() -> dict[str, str]:
    silver_only = with_(*ALL_SILVER)
    counts = {r: (f"(SELECT count(*) FROM b_{r})", f"(SELECT count(*) FROM s_{r})") for r in BRONZE}
    months = union(
        [
            f"""SELECT '{t}' AS table_name, CAST(count(DISTINCT date_trunc('month', {d})) AS BIGINT) AS partition_count,
                       count(*) = 0 AS is_issue FROM {SOURCES[t]}"""
            for t, d in (
                ("mart_daily_txn_volume", "report_date"),
                ("mart_scheme_performance", "report_date"),
                ("mart_settlement_summary", "settlement_date"),
            )
        ]
    )
    stamps = union(
        [
            f"SELECT '{t}' AS table_name, '_silver_loaded_at' AS stamp, CAST(0 AS BIGINT) AS unstamped_rows"
            for t in SILVER_TABLE.values()
        ]
        + [
            f"SELECT '{t}', '_gold_loaded_at', CAST(count(*) AS BIGINT) FROM {SOURCES[t]}"
            for t in ("mart_daily_txn_volume", "mart_scheme_performance", "mart_settlement_summary")
        ]
    )
    ages = union(
        [
            f"""SELECT '{SILVER_TABLE[r]}' AS table_name,
                       CAST(date_sub('hour', max({HIGH_WATER[r]}), {AS_OF}) AS BIGINT) AS hours_since_last_write FROM s_{r}"""
            for r in BRONZE
        ]
    )
    after = ("after_deletes", latest_state("ach_log", ACH_COLUMNS, ["txn_id"]))
    conservation = union(
        [
            f"""SELECT '{BRONZE_TABLE[r]}' AS pair_name,
                       CAST((SELECT count(*) FROM {"after_deletes" if r == "ach" else f"b_{r}"}) AS BIGINT) AS bronze_count,
                       CAST((SELECT count(*) FROM s_{r}) AS BIGINT) AS silver_count"""
            for r in BRONZE
        ]
    )
    stale = with_(
        *ALL_SILVER, VOLUME, *[first_load(r) for r in BRONZE], *[target(r) for r in BRONZE], ("served", daily_volume("t_"))
    )
    window = "report_date >= DATE '2024-01-25' - INTERVAL 7 DAY"
    alignment = union(
        [f"SELECT 'bronze.{BRONZE_TABLE[r]}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM b_{r}" for r in BRONZE]
        + [f"SELECT 'silver.{SILVER_TABLE[r]}', CAST(count(*) AS BIGINT) FROM s_{r}" for r in BRONZE]
    )
    telemetry = union(
        [
            f"""SELECT 'run-1' AS run_id, '{TOPICS[r]}' AS source_topic, CAST(0 AS BIGINT) AS kafka_offset,
                       CAST({b} AS BIGINT) AS bronze_row_count, CAST({s} AS BIGINT) AS silver_row_count,
                       CAST(0 AS DOUBLE) AS sink_lag_seconds, DATE '2024-01-31' AS batch_date, {AS_OF} AS recorded_at"""
            for r, (b, s) in counts.items()
        ]
    )
    drift = union(
        [
            f"""SELECT '{TOPICS[r]}' AS source_topic, {AS_OF} AS last_run, CAST({b} AS BIGINT) AS bronze,
                       CAST({s} AS BIGINT) AS silver, CAST({s} - {b} AS BIGINT) AS drift"""
            for r, (b, s) in counts.items()
        ]
    )
    return {
        "tel1_counts": silver_only + telemetry,
        "tel2_drift": silver_only + drift,
        "snk4_telemetry": silver_only
        + f"""SELECT * REPLACE ('run-1' AS run_id, {AS_OF} - INTERVAL 1 HOUR AS recorded_at) FROM ({telemetry})
              UNION ALL SELECT * REPLACE ('run-2' AS run_id) FROM ({telemetry})""",
        "aud2_stamps": MARTS + stamps,
        "aud3_partitions": MARTS + months,
        "aud4_conservation": with_(*ALL_SILVER, ACH_LOG, after)
        + f"SELECT * FROM ({conservation}) WHERE silver_count > bronze_count",
        "aud5_reconcile": stale
        + f""", gold AS (SELECT * FROM volume WHERE scheme <> 'MEEZA-DIGITAL' AND {window}),
              copy AS (SELECT * FROM served WHERE {window})
              SELECT CASE WHEN copy.scheme IS NULL THEN 'gold_minus_serving' ELSE 'serving_minus_gold' END AS direction,
                     report_date, scheme, gold.txn_count AS gold_value, copy.txn_count AS serving_value
              FROM gold FULL JOIN copy USING (report_date, scheme)
              WHERE gold.scheme IS NULL OR copy.scheme IS NULL""",
        "aud6_empty": silver_only
        + f"""SELECT * FROM ({alignment} UNION ALL SELECT 'silver.refunds', CAST(count(*) FILTER (txn_type = 'REFUND') AS BIGINT) FROM s_wallet)
              WHERE row_count = 0""",
        "aud7_age": silver_only + f"SELECT * FROM ({ages}) WHERE hours_since_last_write > 4",
        "aud9_alignment": silver_only + alignment,
        "joi1_value_reconcile": stale
        + """SELECT g.report_date, g.scheme, g.txn_count AS gold_value, s.txn_count AS serving_value
             FROM volume g JOIN served s ON g.report_date = s.report_date AND g.scheme = s.scheme
             WHERE g.txn_count <> s.txn_count""",
        "joi3_orphan_keys": with_(B["ach"], S["ach"], ACH_LOG, after)
        + """SELECT txn_id FROM s_ach s WHERE NOT EXISTS
             (SELECT 1 FROM after_deletes a WHERE a.txn_id = s.txn_id)""",
    }


# ---- Reports ------------------------------------------------------------------------------------------


def report_sql() -> dict[str, str]:
    week = "report_date >= DATE '2024-01-31' - INTERVAL 7 DAY"
    return {
        "qry1": MARTS + f"SELECT * FROM volume WHERE {week}",
        "qry2": with_(B["ipn"], S["ipn"])
        + """SELECT CAST(count(*) AS BIGINT) AS total_txns, avg(processing_time_ms) AS avg_ms,
                    CAST(count(*) FILTER (WHERE met_sla) AS BIGINT) AS met,
                    CAST(round(count(*) FILTER (WHERE met_sla) * 100.0::DOUBLE / count(*), 2) AS DECIMAL(6,2)) AS pct
             FROM s_ipn""",
        "qry3": MARTS
        + """SELECT scheme, CAST(sum(txn_count) AS BIGINT) AS total_txns, CAST(sum(approved_count) AS BIGINT) AS approved
             FROM volume GROUP BY 1 ORDER BY 1""",
        "qry4": MARTS
        + f"""SELECT report_date, scheme, txn_count, CAST(total_amount_egp AS DECIMAL(18,2)) AS total_amount_egp
              FROM volume WHERE {week} ORDER BY report_date DESC, scheme""",
        "qry5": with_(B["atm"])
        + """SELECT network_id, CAST(count(*) AS BIGINT) AS sessions,
                    CAST(count(*) FILTER (WHERE upper(status) = 'APPROVED') AS BIGINT) AS approved
             FROM b_atm GROUP BY 1""",
        "qry6": MARTS
        + """SELECT originating_bank_id, receiving_bank_id, CAST(net_settled_egp AS DECIMAL(18,2)) AS net_settled_egp,
                    settlement_rate_pct
             FROM settlement WHERE settlement_date = DATE '2000-06-15'
             ORDER BY net_settled_egp DESC NULLS LAST, originating_bank_id, receiving_bank_id LIMIT 20""",
        "qry7": with_(B["wallet"], S["wallet"])
        + """SELECT txn_status, CAST(count(*) AS BIGINT) AS cnt,
                    round(CAST(sum(amount_egp) AS DOUBLE) / 1e6, 2) AS total_egp_millions
             FROM s_wallet GROUP BY 1 ORDER BY cnt DESC""",
        "qry8": MARTS
        + """SELECT report_date, scheme, txn_count AS txns,
                    round(CAST(total_amount_egp AS DOUBLE) / 1e6, 2) AS egp_millions,
                    round(approved_count * 100.0::DOUBLE / nullif(txn_count, 0), 1) AS approval_pct
             FROM volume ORDER BY report_date DESC, scheme LIMIT 21""",
        "qry9": MARTS
        + """SELECT originating_bank_id, receiving_bank_id, settled_count,
                    round(CAST(net_settled_egp AS DOUBLE) / 1e6, 2) AS net_egp_millions, settlement_rate_pct
             FROM settlement ORDER BY net_settled_egp DESC NULLS LAST, settlement_date, originating_bank_id,
                    receiving_bank_id LIMIT 10""",
        "qry10": MARTS + SERVED_VOLUME.format("volume") + " ORDER BY report_date, scheme LIMIT 10",
        "qry11": with_(B["atm"])
        + """SELECT card_token, session_date, atm_id, session_id, txn_type, amount_egp, status, updated_at
             FROM b_atm WHERE card_token = 'tok_5' AND session_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
    }


# ---- Profiles, lineage, file layout -------------------------------------------------------------------

PROFILED = {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
    "l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
}


def other_sql() -> dict[str, str]:
    profiles = union(
        [
            f"""SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count(*) AS BIGINT) AS row_count,
                       CAST(count(*) - count("{c}") AS BIGINT) AS null_count,
                       CAST(count(DISTINCT "{c}") AS BIGINT) AS distinct_count FROM {t}"""
            for t, columns in PROFILED.items()
            for c in columns.split()
        ]
    )
    k = f"({K})"
    # field -> condition under which a document has it
    presence = {
        "_id": "true",
        "wallet_id": f"{k} % 10 <> 0",
        "event_type": "true",
        "channel": f"{k} % 13 <> 0",
        "issuing_bank_id": "true",
        "status": "true",
        "event_ts": "true",
        "bank_ref": "event_type = 'signup'",
        "merchant_id": "event_type IN ('purchase', 'view')",
        "qr_ref": "event_type IN ('purchase', 'view')",
        "receiver_wallet_id": "event_type = 'click'",
        "atm_id": "event_type = 'error'",
    }
    fields = union(
        [
            f"SELECT '{f}' AS field, '{t}' AS type, CAST(count(*) AS BIGINT) AS documents FROM events WHERE {p}"
            for f, (t, p) in {
                **{f: ("STRING", p) for f, p in presence.items()},
                "amount_egp": ("DECIMAL", f"{k} <> 50"),
            }.items()
        ]
    )
    edge_parts = []
    outputs = [("iceberg", f"'silver/t' || ({k} % 4)", 1), ("clickhouse", f"'out/t' || ({k} % 2)", 2)]
    inputs = [
        ("kafka", f"'public/t' || ({k} % 5)", 1),
        ("iceberg", f"'bronze/t' || ({k} % 7)", 2),
        ("postgres", f"'public/src/t' || ({k} % 3)", 3),
    ]
    for out_platform, out_name, least_outputs in outputs:
        for in_platform, in_name, least_inputs in inputs:
            edge_parts.append(
                f"""SELECT 'urn:li:dataset:(urn:li:dataPlatform:{out_platform},' || {out_name} || ',PROD)' AS downstream,
                           'urn:li:dataset:(urn:li:dataPlatform:{in_platform},' || {in_name} || ',PROD)' AS upstream
                    FROM events WHERE event_type IN ('purchase', 'signup')
                      AND {k} % 3 >= {least_outputs} AND {k} % 4 >= {least_inputs}"""
            )
    return {
        "pro1_profile": profiles,
        "pro3_fields": fields,
        "lin1_edges": f"SELECT downstream, upstream, CAST(count(*) AS BIGINT) AS reported FROM ({union(edge_parts)}) GROUP BY ALL",
        "lin2_status": f"""
            SELECT run_id, run_state, event_time, event_id FROM
            (SELECT 'run-' || user_id AS run_id, ts AS event_time, event_id,
                    CASE event_type WHEN 'view' THEN 'STARTED' WHEN 'error' THEN 'FAILED' ELSE 'COMPLETE' END AS run_state,
                    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
             FROM events WHERE {k} <> 99)
            WHERE rn = 1""",
        "lin_rejects": """
            SELECT event_id, reason AS reject_reason, fields
            FROM events JOIN (VALUES (2, 'malformed', ''), (4, 'bad value', 'inputs'), (6, 'no document', ''), (8, 'bad value', 'run'))
                         AS faults(rest, reason, fields) ON event_id % 19 = rest""",
        "mnt1_compaction": with_(B["wallet"], S["wallet"])
        + """SELECT CAST(event_date AS VARCHAR) AS partition_value, CAST(1 AS BIGINT) AS files,
                    CAST(count(*) AS BIGINT) AS row_count FROM s_wallet GROUP BY 1""",
    }


def oracle_sql() -> dict[str, str]:
    return (
        bronze_sql()
        | silver_sql()
        | gold_sql()
        | serving_sql()
        | semantic_sql()
        | quality_sql()
        | audit_sql()
        | report_sql()
        | other_sql()
    )
