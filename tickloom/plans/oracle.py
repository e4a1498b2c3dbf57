"""ANSI SQL twins of the registered queries, over the same tables."""

MBO = """
raw_mbo AS (
  SELECT event_time, event_time + 1500000 AS ingest_time, 'SYNTH' AS venue, contract_id AS symbol,
    'FUT' AS instrument_type, 'SYN' AS underlier, contract_id, action, order_id, side,
    CAST(CASE side WHEN 'B' THEN 4000 - 0.25 * (1 + lvl) WHEN 'S' THEN 4000 + 0.25 * lvl
         ELSE 4000 END AS DOUBLE) AS price,
    size, sequence, props AS payload
  FROM (
    SELECT {time} AS event_time, 'SYN' || CAST(user_id % 8 AS VARCHAR) AS contract_id,
      CASE event_type WHEN 'click' THEN 'A' WHEN 'view' THEN 'A' WHEN 'purchase' THEN 'T'
        ELSE 'C' END AS action,
      event_id AS order_id,
      CASE WHEN event_id % 7 = 0 THEN 'N' WHEN event_id % 2 = 0 THEN 'B' ELSE 'S' END AS side,
      CAST(round(value * 4) AS BIGINT) % 40 AS lvl, 1 + event_id % 10 AS size,
      event_id AS sequence, props
    FROM events)
),
mbo AS (
  SELECT *, strftime(timezone('America/New_York', timezone('UTC', make_timestamp(event_time // 1000))),
    '%Y-%m-%d') AS session_date
  FROM raw_mbo
)"""
STEADY = MBO.format(time="1704132000000000000 + event_id * 250000000")
DAILY = MBO.format(time="epoch_us(ts) * 1000")

NORM = """
norm AS (
  SELECT *, make_timestamp(event_time // 1000) AS event_ts,
    timezone('America/New_York', timezone('UTC', make_timestamp(event_time // 1000))) AS event_ts_est,
    CAST(CASE WHEN upper(side) IN ('B', 'BUY', 'BID') THEN 1
         WHEN upper(side) IN ('S', 'SELL', 'ASK', 'A') THEN -1 ELSE 0 END AS INTEGER) AS side_sign
  FROM mbo
)"""

BAR = """
grouped AS (
  SELECT session_date, underlier, instrument_type, contract_id,
    event_time - event_time % {width} AS bucket_ns,
    count(*) AS event_count, CAST(sum(size) AS BIGINT) AS size_total,
    CAST(sum(CASE WHEN side_sign = 1 THEN size ELSE 0 END) AS BIGINT) AS buy_size,
    CAST(sum(CASE WHEN side_sign = -1 THEN size ELSE 0 END) AS BIGINT) AS sell_size,
    sum(price * size) AS notional, min(price) AS price_min, max(price) AS price_max,
    arg_max(price, sort_key) AS price_last,
    max(CASE WHEN side_sign = 1 THEN price END) AS best_bid,
    min(CASE WHEN side_sign = -1 THEN price END) AS best_ask
  FROM (SELECT *, row_number() OVER (ORDER BY event_time, price) AS sort_key FROM norm)
  GROUP BY ALL
),
bar AS (
  SELECT session_date, underlier, instrument_type, contract_id, bucket_ns,
    make_timestamp(bucket_ns // 1000) AS bucket_ts, event_count, size_total, buy_size, sell_size,
    notional, price_min, price_max, price_last, best_bid, best_ask,
    CASE WHEN size_total > 0 THEN notional / size_total END AS vwap,
    buy_size - sell_size AS ofi,
    CASE WHEN buy_size + sell_size > 0
      THEN CAST(buy_size - sell_size AS DOUBLE) / (buy_size + sell_size) ELSE 0.0::DOUBLE END AS ofi_ratio,
    best_ask - best_bid AS spread, (best_ask + best_bid) / 2.0 AS mid
  FROM grouped
)"""
BAR_5S = BAR.format(width=5_000_000_000)
BAR_1H = BAR.format(width=3_600_000_000_000)

SERIES = "PARTITION BY session_date, underlier, instrument_type, contract_id ORDER BY bucket_ns"
FEATURES = f"""
feat AS (
  SELECT *, mid - lag(mid) OVER (w) AS mid_change, lead(mid, 24) OVER (w) AS mid_future,
    CASE WHEN row_number() OVER (w) = 1 THEN 0.0::DOUBLE ELSE mid - lag(mid) OVER (w) END AS stream_change
  FROM bar WINDOW w AS ({SERIES})
),
timed AS (
  SELECT a.*, z.mid AS mid_at
  FROM bar a LEFT JOIN bar z ON a.session_date = z.session_date AND a.underlier = z.underlier
    AND a.instrument_type = z.instrument_type AND a.contract_id = z.contract_id
    AND z.bucket_ns = a.bucket_ns + 120000000000
),
vec AS (
  SELECT *, coalesce(ofi_ratio, 0) AS f0, coalesce(spread, 0) AS f1, coalesce(mid_change, 0) AS f2,
    coalesce(vwap, 0) AS f3, CAST(event_count AS DOUBLE) AS f4,
    CAST(CASE WHEN mid_future IS NULL THEN NULL WHEN mid_future > mid THEN 1 ELSE 0 END
      AS INTEGER) AS label
  FROM feat
),
setup AS (
  SELECT bucket_ns AS vector_time, underlier || '_MODEL' AS model_id, contract_id,
    '5s' AS lookback_spec, f0, f1, f2, f3, f4,
    sha256(concat_ws(',', {", ".join(f"CAST(CAST(floor(f{i} * 1000000 + 0.5) AS BIGINT) AS VARCHAR)" for i in range(5))})) AS feature_hash,
    label, 'silver.feature_primitives' AS data_version, session_date, underlier, instrument_type
  FROM vec
)"""

LEVELS = """
deltas AS (
  SELECT contract_id, {segment} AS segment, side_sign, price, event_time, sequence,
    CASE action WHEN 'A' THEN size ELSE -size END AS delta
  FROM norm WHERE action IN ('A', 'C') AND side_sign <> 0
),
sums AS (
  SELECT *, sum(delta) OVER (PARTITION BY contract_id, segment, side_sign, price
    ORDER BY event_time, sequence) AS s FROM deltas
),
levels AS (
  SELECT contract_id, segment, side_sign, price, event_time, sequence,
    CAST(s - least(0, min(s) OVER (PARTITION BY contract_id, segment, side_sign, price
      ORDER BY event_time, sequence)) AS BIGINT) AS level_size
  FROM sums
)"""

TOP = """
closes AS (
  SELECT contract_id, segment, side_sign, price, event_time - event_time % 5000000000 AS a,
    arg_max(level_size, event_time) AS size FROM levels GROUP BY ALL
),
spans AS (
  SELECT *, lead(a) OVER (PARTITION BY contract_id, segment, side_sign, price ORDER BY a) AS b
  FROM closes
),
buckets AS (
  SELECT contract_id, {segment} AS segment, event_time - event_time % 5000000000 AS bucket_ns,
    count(*) AS event_count
  FROM norm GROUP BY ALL
),
top AS (
  SELECT k.contract_id, k.bucket_ns, k.event_count,
    max(CASE WHEN side_sign = 1 THEN price END) AS best_bid,
    min(CASE WHEN side_sign = -1 THEN price END) AS best_ask
  FROM buckets k LEFT JOIN spans s ON s.contract_id = k.contract_id AND s.segment = k.segment
    AND s.size > 0 AND s.a <= k.bucket_ns AND (s.b IS NULL OR s.b > k.bucket_ns)
  GROUP BY k.contract_id, k.segment, k.bucket_ns, k.event_count
)"""
ONE_SEGMENT = {"segment": "0"}

RECORDS = """
records AS (
  SELECT event_time AS ts_event, ingest_time AS ts_recv,
    CASE WHEN order_id % 13 = 0 THEN NULL WHEN order_id % 17 = 0 THEN 'SYN1-SYN2'
      ELSE symbol END AS symbol,
    action, side, order_id, size, sequence, price,
    100 + order_id % 8 AS instrument_id, 1 + order_id % 3 AS publisher_id, order_id % 256 AS flags,
    order_id % 4 AS channel_id, order_id % 1000 AS ts_in_delta,
    CAST(CASE WHEN order_id % 11 = 0 THEN 161 ELSE 160 END AS INTEGER) AS rtype
  FROM mbo
),
packed AS (
  SELECT *, '{"instrument_id":' || instrument_id || ',"publisher_id":' || publisher_id
    || ',"flags":' || flags || ',"channel_id":' || channel_id || ',"ts_in_delta":' || ts_in_delta
    || ',"rtype":' || rtype || '}' AS packed_payload
  FROM records
)"""

ENVELOPE = (
    "event_time, ingest_time, venue, symbol, instrument_type, underlier, contract_id, action,"
    " order_id, side, price, size, sequence, payload"
)
FROM_RECORD = (
    "ts_event AS event_time, ts_recv AS ingest_time, 'SYNTH' AS venue, symbol,"
    " 'FUT' AS instrument_type, 'SYN' AS underlier, symbol AS contract_id, action, order_id, side,"
    " price, size, sequence, packed_payload AS payload, '2024-01-01' AS session_date"
)
ORDERBOOK = (
    "session_date, underlier, instrument_type, contract_id, bucket_ns, bucket_ts, best_bid,"
    " best_ask, mid, spread, buy_size, sell_size"
)
PRIMITIVES = (
    "session_date, underlier, instrument_type, contract_id, bucket_ns, bucket_ts, event_count,"
    " size_total, buy_size, sell_size, ofi, ofi_ratio, vwap, mid, spread"
)

# The malformed broker rows, in the order in which the inputs use them.
DEAD = """
SELECT CASE (order_id // 19) % 8 WHEN 0 THEN 'not json' WHEN 1 THEN '{"event_time":1'
    WHEN 2 THEN '[1]' WHEN 3 THEN '""' WHEN 4 THEN '{}' WHEN 5 THEN '' WHEN 6 THEN NULL
    ELSE '{"size":"many"}' END AS raw_record,
  CASE (order_id // 19) % 8 WHEN 4 THEN 'Missing required field'
    ELSE 'JSON parse failure' END AS error_message,
  CAST(order_id % 4 AS INTEGER) AS source_partition, CAST(order_id AS VARCHAR) AS source_offset,
  CAST(0 AS INTEGER) AS retry_count
FROM mbo WHERE order_id % 19 = 0"""

_VEC = (
    "contract_id, bucket_ns AS vector_time, session_date, underlier, instrument_type, ofi_ratio,"
    " spread, stream_change AS mid_change, vwap, event_count"
)
_P = "1.0 / (1.0 + exp(-z))"


def _logistic(kept: str = "", rounds: int = 8, ridge: float = 0.0) -> list[str]:
    """Newton's method on price and size, a round per common table expression.

    A round's three unknowns come from the ratios of determinants.
    """
    det = "{0}*({4}*{8}-{5}*{7}) - {1}*({3}*{8}-{5}*{6}) + {2}*({3}*{7}-{4}*{6})"
    matrix = ["h00", "h01", "h02", "h01", "h11", "h12", "h02", "h12", "h22"]
    solved = []
    for k in range(3):
        own = [f"g{i // 3}" if i % 3 == k else m for i, m in enumerate(matrix)]
        solved.append(f"s.b{k} + ({det.format(*own)}) / ({det.format(*matrix)}) AS b{k}")
    terms = {"g0": "y - p", "g1": "(y - p) * u1", "g2": "(y - p) * u2", "h00": "c", "h01": "c * u1", "h02": "c * u2",
             "h11": "c * u1 * u1", "h12": "c * u1 * u2", "h22": "c * u2 * u2"}
    extra = {f"g{k}": f" - {ridge} * count(*) * min(b{k})" for k in (1, 2)} | {f"h{k}{k}": f" + {ridge} * count(*)" for k in (1, 2)}
    sums = ", ".join(f"sum({t}){extra.get(n, '')} AS {n}" for n, t in terms.items())
    steps = [
        f"""
step{i + 1} AS (
  SELECT {", ".join(solved)} FROM step{i} s, (
    SELECT {sums} FROM (SELECT *, p * (1 - p) AS c FROM (
      SELECT u.*, b1, b2, 1 / (1 + exp(-(b0 + b1 * u1 + b2 * u2))) AS p FROM u, step{i}) a) b) d
)"""
        for i in range(rounds)
    ]
    return [
        f"""
x AS (
  SELECT contract_id, event_time, price, CAST(size AS DOUBLE) AS size, CAST(row_id % 2 AS DOUBLE) AS y
  FROM (SELECT *, row_number() OVER (ORDER BY event_time, sequence) AS row_id FROM mbo {kept})
),
shape AS (SELECT avg(price) AS m1, stddev_pop(price) AS s1, avg(size) AS m2, stddev_pop(size) AS s2 FROM x),
u AS (SELECT x.*, (price - m1) / s1 AS u1, (size - m2) / s2 AS u2 FROM x, shape),
step0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)""",
        *steps,
        f"""
fitted AS (SELECT b1 / s1 AS w1, b2 / s2 AS w2, b0 - b1 / s1 * m1 - b2 / s2 * m2 AS w0 FROM step{rounds}, shape),
scored AS (SELECT x.*, 1 / (1 + exp(-(w0 + w1 * price + w2 * size))) AS p FROM x, fitted)""",
    ]


_ACCURACY = "count(*) AS record_count, round(avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END), 9) AS accuracy"
_MODEL_SCORES = """
SELECT contract_id, event_time, price, size, CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction,
  round(1 - p, 6) AS prob_0, round(p, 6) AS prob_1 FROM scored"""


def _scores(z_source: str, prediction: str = None, error: str = None) -> str:
    """Logistic scores with the fixed weights of the registered scorer."""
    p1, p0 = f"round({_P}, 9)", f"round(1.0 - {_P}, 9)"
    pred = f"CASE WHEN {_P} >= 0.5 THEN 1 ELSE 0 END"
    message = "CAST(NULL AS VARCHAR)"
    if error:
        pred, message = f"CASE WHEN {error} THEN -1 ELSE {pred} END", (
            f"CASE WHEN {error} THEN 'Error on attempt 3/3: bad vector' END"
        )
        p0, p1 = (f"CASE WHEN {error} THEN 0 ELSE {p} END" for p in (p0, p1))
    return f""",
zs AS (
  SELECT *, -1.5::DOUBLE + x0 * 0.8::DOUBLE + x1 * (-0.05)::DOUBLE + x2 * 0.1::DOUBLE
    + x3 * 0.0005::DOUBLE + x4 * (-0.2)::DOUBLE AS z
  FROM (SELECT *, {z_source} FROM vec)
)
SELECT contract_id, bucket_ns AS vector_time, session_date, 'ES_MODEL' AS model_id,
  CAST(NULL AS DOUBLE) AS close_price, CAST({pred} AS INTEGER) AS prediction,
  {message} AS inference_error, '1' AS model_version, CAST({p0} AS DOUBLE) AS prob_0,
  CAST({p1} AS DOUBLE) AS prob_1
FROM zs"""


_STREAM_X = "f0 AS x0, f1 AS x1, coalesce(stream_change, 0) AS x2, f3 AS x3, f4 AS x4"
_HOLED_X = ", ".join(
    f"CASE WHEN event_count = 3 THEN 0.0 ELSE {v} END AS x{i}"
    for i, v in enumerate(["f0", "f1", "coalesce(stream_change, 0)", "f3", "f4"])
)


def _seen(number: str, clock: str) -> str:
    """The watermark that each of four turns finds, ten minutes behind the turns before it."""
    return f"""
turns AS (SELECT {number} % 4 AS turn, max({clock}) AS latest FROM mbo GROUP BY ALL),
seen AS (
  SELECT later.turn, max(earlier.latest) // 1000000 * 1000000 - 600000000000 AS watermark
  FROM turns later JOIN turns earlier ON earlier.turn < later.turn
  GROUP BY ALL
)"""


_MESSAGE = ", ".join(f"{c} := {c}" for c in ENVELOPE.replace(" ", "").split(","))


_VALUE_BYTES = f"""CAST(CASE WHEN order_id % 19 = 0 THEN octet_length(CAST(raw_record AS BLOB))
    ELSE strlen(CAST(to_json(struct_pack({_MESSAGE})) AS VARCHAR)) END AS INTEGER)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def oracle_sql() -> dict[str, str]:
    steady, daily = _with(STEADY), _with(DAILY)
    norm = _with(STEADY, NORM)
    bar = _with(STEADY, NORM, BAR_5S)
    vec = _with(STEADY, NORM, BAR_5S, FEATURES)
    records = _with(STEADY, RECORDS)
    model = _with(STEADY, *_logistic(rounds=12, ridge=0.01))
    one = {k: v.format(**ONE_SEGMENT) for k, v in {"levels": LEVELS, "top": TOP}.items()}
    levels = _with(STEADY, NORM, one["levels"])
    top = _with(STEADY, NORM, one["levels"], one["top"])
    # The pause comes after the middle of the data; a bucket before and after it never coincide.
    paused = STEADY.replace(
        "mbo AS (\n  SELECT *,",
        """shifted_mbo AS (
  SELECT * REPLACE (event_time + CASE WHEN event_time > (lo + hi) // 2
    THEN 3600000000000 ELSE 0 END AS event_time), event_time > (lo + hi) // 2 AS after_pause
  FROM raw_mbo, (SELECT min(event_time) AS lo, max(event_time) AS hi FROM raw_mbo)
),
mbo AS (
  SELECT *,""",
    ).replace("FROM raw_mbo\n)", "FROM shifted_mbo\n)")
    seg = {"segment": "after_pause"}
    expiry = _with(paused, NORM, LEVELS.format(**seg), TOP.format(**seg))
    kept = "WHERE rtype = 160 AND symbol IS NOT NULL AND symbol NOT LIKE '%-%'"
    mid_day = "session_date = '2024-01-15'"
    streamed = top.rstrip() + "," + BAR_5S + """
SELECT session_date, underlier, instrument_type, contract_id, bucket_ns, bucket_ts,
  bar.event_count, size_total, buy_size, sell_size, vwap, ofi, ofi_ratio,
  (top.best_ask + top.best_bid) / 2.0 AS mid, top.best_ask - top.best_bid AS spread,
  top.best_bid, top.best_ask
FROM bar JOIN top USING (contract_id, bucket_ns)"""
    return {
        "src_envelope_decode": steady + f"""
SELECT {ENVELOPE}, make_timestamp(ingest_time // 1000) AS enqueued_time,
  CAST(order_id AS VARCHAR) AS source_offset, order_id AS source_sequence, session_date
FROM mbo WHERE order_id % 19 <> 0""",
        "src_offsets_stream": steady + f"""
, broker AS (
  SELECT order_id AS "offset", CAST(order_id % 4 AS INTEGER) AS partition, make_timestamp(ingest_time // 1000) AS timestamp,
    {_VALUE_BYTES} AS value_bytes, count(*) OVER () AS n, row_number() OVER (PARTITION BY order_id % 4 ORDER BY order_id) - 1 AS place,
    min(order_id) OVER (PARTITION BY order_id % 4) AS low
  FROM mbo LEFT JOIN (SELECT raw_record, CAST(source_offset AS BIGINT) AS o FROM ({DEAD})) d ON d.o = order_id
)
SELECT 'earliest' AS mode, partition, "offset", value_bytes, timestamp,
  CAST(("offset" - low) // ((n + 5) // 6) AS INTEGER) AS batch FROM broker
UNION ALL SELECT 'latest', partition, "offset", value_bytes, timestamp, NULL FROM broker WHERE "offset" >= n // 2""",
        "src_table_stream": steady + "SELECT contract_id, event_time, size FROM mbo",
        "scan_partition": daily + f"SELECT {ENVELOPE}, session_date FROM mbo WHERE {mid_day}",
        "scan_table": steady + f"SELECT {ENVELOPE}, session_date FROM mbo",
        "raw_to_envelope": records + f"SELECT {FROM_RECORD} FROM packed",
        "sink_replace_slice": daily + f"""
SELECT order_id, CASE WHEN {mid_day} THEN size + 1000 ELSE size END AS size, session_date
FROM mbo WHERE session_date <> '2024-01-16'""",
        "sink_publish_slice": daily + f"""
SELECT order_id, CASE WHEN {mid_day} THEN size + 1000 ELSE size END AS size, session_date
FROM mbo WHERE session_date IN ('2024-01-14', '2024-01-15')""",
        "sink_stream_append": steady + f"SELECT {ENVELOPE}, session_date FROM mbo",
        "export_snapshot": vec + "SELECT * REPLACE ('OTHER_MODEL' AS model_id) FROM setup",
        "flt_record_type": records + "SELECT order_id, rtype FROM records WHERE rtype = 160",
        "flt_symbol_present": records
        + "SELECT order_id, symbol FROM records WHERE symbol IS NOT NULL",
        "flt_outright": records
        + "SELECT order_id, symbol FROM records WHERE symbol NOT LIKE '%-%'",
        "flt_session_window": steady + """
SELECT order_id, event_time FROM mbo
WHERE make_timestamp(event_time // 1000) >= timezone('UTC',
    timezone('America/New_York', TIMESTAMP '2024-01-01 13:10:00'))
  AND make_timestamp(event_time // 1000) < timezone('UTC',
    timezone('America/New_York', TIMESTAMP '2024-01-01 13:30:00'))""",
        "dlq_valid": steady + """
SELECT order_id, contract_id, CAST(order_id AS VARCHAR) AS source_offset,
  order_id AS source_sequence FROM mbo WHERE order_id % 19 <> 0""",
        "dlq_invalid": steady + DEAD,
        "guard_nonempty": steady + f"SELECT {ENVELOPE}, session_date FROM mbo",
        "guard_training_set": steady
        + "SELECT count(*) AS record_count, count(DISTINCT sequence % 2) AS class_count FROM mbo",
        "json_parse": steady + f"SELECT {ENVELOPE} FROM mbo WHERE order_id % 19 <> 0",
        "ns_to_ts": daily
        + "SELECT order_id, event_time, make_timestamp(event_time // 1000) AS event_ts FROM mbo",
        "ts_to_local": _with(DAILY, NORM) + "SELECT order_id, event_ts_est FROM norm",
        "session_date": daily + "SELECT order_id, session_date FROM mbo",
        "side_sign": norm + "SELECT order_id, side, side_sign FROM norm",
        "signed_size": norm + "SELECT order_id, size * side_sign AS signed_size FROM norm",
        "mbo_normalized": norm + "SELECT *, size * side_sign AS signed_size FROM norm",
        "bucket_floor": daily + """
SELECT order_id, event_time - event_time % 5000000000 AS bucket_ns,
  make_timestamp((event_time - event_time % 5000000000) // 1000) AS bucket_ts FROM mbo""",
        "payload_pack": records + "SELECT order_id, packed_payload AS payload FROM packed",
        "feature_vector": vec + "SELECT contract_id, bucket_ns, f0, f1, f2, f3, f4 FROM vec",
        "feature_hash": vec
        + "SELECT contract_id, vector_time AS bucket_ns, feature_hash FROM setup",
        "feature_hash_json": bar + """
SELECT contract_id, bucket_ns, sha256('[' || concat_ws(',', CAST(event_count::DOUBLE AS VARCHAR),
  CAST(size_total::DOUBLE AS VARCHAR), CAST(ofi::DOUBLE AS VARCHAR), CAST(price_min AS VARCHAR),
  CAST(coalesce(spread, 0)::DOUBLE AS VARCHAR)) || ']') AS feature_hash FROM bar""",
        "label_forward": vec + "SELECT contract_id, bucket_ns, label FROM vec",
        "label_forward_strict": vec + """
SELECT contract_id, bucket_ns, CAST(CASE WHEN mid IS NULL OR mid_at IS NULL THEN NULL
  WHEN mid_at > mid THEN 1 ELSE 0 END AS INTEGER) AS label FROM timed""",
        "optional_columns": steady + """
SELECT order_id, venue, CAST(NULL AS DOUBLE) AS close_price, 'ES_MODEL' AS model_id FROM mbo""",
        "bar_5s": bar + "SELECT * FROM bar",
        "bar_1h_daily": _with(DAILY, NORM, BAR_1H) + "SELECT * FROM bar",
        "orderbook_state": bar + f"SELECT {ORDERBOOK} FROM bar",
        "feature_primitives": bar + f"SELECT {PRIMITIVES} FROM bar",
        "mid_change": vec + "SELECT contract_id, bucket_ns, mid, mid_change FROM feat",
        "mid_future": vec + "SELECT contract_id, bucket_ns, mid_future FROM feat",
        "mid_future_time": vec
        + "SELECT contract_id, bucket_ns, mid_at AS mid_future FROM timed",
        "setup_vectors": vec + "SELECT * FROM setup",
        "labels": vec + """
SELECT vector_time, model_id, contract_id, feature_hash, label, session_date, underlier,
  instrument_type FROM setup""",
        "global_row_number": steady + """
SELECT row_id, CAST(row_id % 2 AS INTEGER) AS label, order_id, price, CAST(size AS DOUBLE) AS size
FROM (SELECT *, row_number() OVER (ORDER BY event_time, sequence) AS row_id FROM mbo)""",
        "level_deltas": norm + """
SELECT contract_id, event_time - event_time % 5000000000 AS bucket_ns, side_sign, price, action,
  CAST(sum(size) AS BIGINT) AS size_sum
FROM norm WHERE action IN ('A', 'C') AND side_sign <> 0 GROUP BY ALL""",
        "trade_stats": norm + """
SELECT contract_id, bucket_ns, last_trade_price, last_trade_size,
  CAST(sum(volume) OVER (PARTITION BY contract_id ORDER BY bucket_ns) AS BIGINT) AS total_volume
FROM (SELECT contract_id, event_time - event_time % 5000000000 AS bucket_ns,
        arg_max(price, sequence) AS last_trade_price, arg_max(size, sequence) AS last_trade_size,
        sum(size) AS volume
      FROM norm WHERE action = 'T' GROUP BY ALL)""",
        "book_levels": levels + "SELECT * EXCLUDE (segment) FROM levels",
        "book_top": top + """
SELECT contract_id, bucket_ns, best_bid, best_ask, best_ask - best_bid AS spread,
  (best_ask + best_bid) / 2.0 AS mid FROM top""",
        "book_snapshot": levels + """
SELECT contract_id, side_sign, price, level_size FROM (
  SELECT contract_id, side_sign, price, arg_max(level_size, sequence) AS level_size
  FROM levels GROUP BY ALL) WHERE level_size > 0""",
        "book_snapshot_at": levels + """
SELECT contract_id, side_sign, price, level_size FROM (
  SELECT contract_id, side_sign, price, arg_max(level_size, sequence) AS level_size
  FROM levels WHERE event_time <= (SELECT (min(event_time) + max(event_time)) // 2 FROM norm)
  GROUP BY ALL) WHERE level_size > 0""",
        "dedup_batch": steady + f"SELECT {ENVELOPE}, session_date FROM mbo",
        "dedup_stream": steady + f"""
SELECT {ENVELOPE}, session_date, order_id AS source_sequence FROM mbo WHERE order_id % 19 <> 0""",
        "fanout_handoff": steady + f"""
SELECT {ENVELOPE}, session_date, order_id AS source_sequence FROM mbo WHERE order_id % 19 <> 0""",
        "stream_fanout": steady + f"""
SELECT 'bronze' AS sink, CAST(order_id AS VARCHAR) AS source_offset, CAST(NULL AS VARCHAR) AS reason
FROM mbo WHERE order_id % 19 <> 0
UNION ALL SELECT 'dead', source_offset, error_message FROM ({DEAD})""",
        "bar_stream": bar + "SELECT * FROM bar",
        "book_stream": streamed,
        "book_stream_unordered": streamed,
        # Late: in a bucket that ended ten minutes before the latest event of an earlier turn.
        "late_rows": _with(STEADY, _seen("order_id", "event_time")) + """
SELECT contract_id, underlier, instrument_type, event_time, sequence, order_id, action, side,
  price, size
FROM mbo JOIN seen ON seen.turn = mbo.order_id % 4
WHERE event_time < watermark // 5000000000 * 5000000000""",
        # The watermark is ten minutes behind the last event; whole buckets before it are applied.
        "book_state_snapshot": levels + """
SELECT contract_id, side_sign, price, level_size FROM (
  SELECT contract_id, side_sign, price, arg_max(level_size, sequence) AS level_size
  FROM levels WHERE event_time < (SELECT (max(event_time) // 1000000 * 1000000 - 600000000000)
    // 5000000000 * 5000000000 FROM norm)
  GROUP BY ALL) WHERE level_size > 0""",
        "dedup_late": _with(STEADY, _seen("order_id", "ingest_time")) + f"""
, broker AS (
  SELECT order_id AS "offset", CAST(order_id % 4 AS INTEGER) AS partition, ingest_time,
    make_timestamp(ingest_time // 1000) AS timestamp, coalesce(ingest_time // 1000 <= watermark // 1000, false) AS late,
    {_VALUE_BYTES} AS value_bytes
  FROM mbo LEFT JOIN seen ON seen.turn = order_id % 4
  LEFT JOIN (SELECT raw_record, CAST(source_offset AS BIGINT) AS o FROM ({DEAD})) d ON d.o = order_id
)
SELECT partition, "offset", value_bytes, timestamp, late FROM broker
UNION ALL SELECT partition, "offset", value_bytes, timestamp, late FROM broker WHERE late AND "offset" % 10 = 0""",
        "bar_late": _with(STEADY, NORM, _seen("order_id", "event_time"), """
marked AS (
  SELECT norm.*, event_time - event_time % 5000000000 AS bucket_ns,
    coalesce(event_time // 5000000000 * 5000000000 + 5000000000 <= watermark, false) AS late
  FROM norm LEFT JOIN seen ON seen.turn = order_id % 4
)""") + """
SELECT contract_id, bucket_ns, count(*) AS event_count, CAST(sum(size) AS BIGINT) AS size_total,
  sum(price * size) AS notional, arg_max(price, event_time) AS price_last,
  max(CASE WHEN side_sign = 1 THEN price END) AS best_bid, min(CASE WHEN side_sign = -1 THEN price END) AS best_ask,
  CAST(NULL AS BIGINT) AS order_id, CAST(NULL AS VARCHAR) AS action, CAST(NULL AS BIGINT) AS late_size
FROM marked WHERE NOT late GROUP BY ALL
UNION ALL
SELECT contract_id, event_time, 1, size, price * size, price, CASE WHEN side_sign = 1 THEN price END,
  CASE WHEN side_sign = -1 THEN price END, order_id, action, size
FROM marked WHERE late""",
        "state_expiry": expiry
        + "SELECT contract_id, bucket_ns, event_count, best_bid, best_ask FROM top",
        "gold_stream": vec + f"""
SELECT {_VEC}, f0, f1, coalesce(stream_change, 0) AS f2, f3, f4, 'ES_MODEL' AS model_id FROM vec""",
        "msg_gold_json": vec + """
SELECT contract_id, bucket_ns AS vector_time, 'ES_MODEL' AS model_id, ofi_ratio, spread,
  stream_change AS mid_change, vwap, event_count FROM vec""",
        "score_vectors": vec.rstrip() + _scores(_HOLED_X),
        "score_failures": vec.rstrip() + _scores(_HOLED_X, error="x4 = 2.0"),
        "score_stream": vec.rstrip() + _scores(_STREAM_X),
        "msg_score_json": "SELECT * EXCLUDE (session_date) FROM ("
        + vec.rstrip() + _scores(_STREAM_X) + ")",
        "train_model": model + """
SELECT (SELECT count(*) FROM x) AS record_count, round(w1, 6) AS weight_price, round(w2, 6) AS weight_size,
  round(w0, 6) AS intercept FROM fitted""",
        "model_accuracy": model + f"SELECT {_ACCURACY} FROM scored",
        "model_registry": model + f"SELECT {_ACCURACY}, true AS names_model, true AS has_time FROM scored",
        "score_table": model + _MODEL_SCORES,
        "pipe_train_score": _with(STEADY, *_logistic("WHERE order_id % 19 <> 0")) + _MODEL_SCORES,
        "pipe_raw_to_bronze": records + f"""
SELECT {FROM_RECORD} FROM packed {kept}
  AND make_timestamp(ts_event // 1000) >= timezone('UTC',
    timezone('America/New_York', TIMESTAMP '2024-01-01 13:01:00'))
  AND make_timestamp(ts_event // 1000) < timezone('UTC',
    timezone('America/New_York', TIMESTAMP '2024-01-01 13:40:00'))""",
        "pipe_bronze_to_silver": bar + "SELECT * FROM bar WHERE session_date = '2024-01-01'",
        "pipe_published": vec + "SELECT * FROM setup WHERE session_date = '2024-01-01'",
        "pipe_silver_to_gold": vec + "SELECT * FROM setup WHERE session_date = '2024-01-01'",
    }
