"""Streaming queries (T*): each reads the driver table as a file stream, drains
it (availableNow) and returns the sink as a batch frame; the SQL twin is the
batch answer. Where several micro-batches are the point, the table arrives
slice by slice (``runner.Arrivals``)."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from ..operators.relational import hash_unit, hash_unit_sql
from ..plans import contest as C
from ..session import scratch_path
from ..streaming import online as ON
from ..streaming import panes as PN
from ..streaming import runner as RN
from ..streaming import transforms as ST
from ..tables import Tables
from . import query

WEEKS = ["2024-01-08", "2024-01-15", "2024-01-22"]
PV_SQL = """pv AS (SELECT ts, '/p/' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR) AS url,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, CAST(user_id % 10 AS INTEGER) AS zip,
  user_id AS usr FROM events)"""
WEEK_SQL = ("CASE WHEN ts < TIMESTAMP '2024-01-08' THEN 0 WHEN ts < TIMESTAMP '2024-01-15' THEN 1 "
            "WHEN ts < TIMESTAMP '2024-01-22' THEN 2 ELSE 3 END")


def _week():
    ts = F.col("ts")
    b = [F.lit(w).cast("timestamp_ntz") for w in WEEKS]
    return F.when(ts < b[0], 0).when(ts < b[1], 1).when(ts < b[2], 2).otherwise(3)


def _event_weeks(spark, sf):
    return RN.Arrivals(Tables(spark, sf).events, _week(), "event-weeks")


def _event_stream(spark, sf):
    return RN.table_stream(spark, sf, "events")


def _lines(texts):
    return texts.select(F.explode(F.split("text", "\n")).alias("value"))


def _line_stream(spark, sf):
    """Document text as a stream of lines."""
    return _lines(RN.table_stream(spark, sf, "documents"))


_LINES_SQL = "lines AS (SELECT unnest(string_split(text, chr(10))) AS value, lang FROM documents)"


@query("stream_word_count", f"""WITH {_LINES_SQL}
SELECT word, COUNT(*) AS count FROM (SELECT unnest(string_split(value, ' ')) AS word FROM lines) GROUP BY word""")
def stream_word_count(spark, sf):
    return RN.run_to_table(ST.word_count(_line_stream(spark, sf)), "update", keys=["word"], name="wc")


@query("stream_batch_count", f"""
SELECT CAST({WEEK_SQL} AS INTEGER) AS batch, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2""")
def stream_batch_count(spark, sf):
    """Per-micro-batch counts (T2): one week of events per batch."""
    weeks = _event_weeks(spark, sf)

    def per_batch(b, bid):
        return b.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("batch", F.lit(bid))
    out = RN.run_to_table(weeks.stream(), "append", name="batchcount", batch_fn=per_batch, arrivals=weeks)
    return out.select(F.col("batch").cast("int").alias("batch"), "event_type", "n")


@query("stream_file_source", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def stream_file_source(spark, sf):
    s = _event_stream(spark, sf)
    return RN.run_to_table(s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "update", keys=["event_type"], name="fs")


def _windowed(spark, sf, length, slide, keys=(), value=None, name="win"):
    s = ST.with_event_time(_event_stream(spark, sf), "ts", "1 hour")
    g = ST.windowed_counts(s, "ts", length, slide, keys, value)
    g = g.select(*ST.window_bounds(), *keys, *(["n", "total"] if value else ["n"]))
    return RN.run_to_table(g, "update", keys=["window_start", "window_end", *keys], name=name)


def _sliding_sql(step: int, k: int, select: str, group: str, src: str = "events", pre: str = "",
                 unit: str = "MINUTE") -> str:
    return f"""{pre}
SELECT time_bucket(INTERVAL {step} {unit}, ts) - i * INTERVAL {step} {unit} AS window_start,
       time_bucket(INTERVAL {step} {unit}, ts) - i * INTERVAL {step} {unit} + INTERVAL {step * k} {unit} AS window_end,
       {select}
FROM {src}, range({k}) r(i) GROUP BY window_start, window_end{group}"""


@query("stream_tumbling", _sliding_sql(60, 1, "event_type, COUNT(*) AS n", ", event_type"))
def stream_tumbling(spark, sf):
    """T5 / O2: the windowed result in window order."""
    out = _windowed(spark, sf, "1 hour", None, ["event_type"], name="tumble")
    return out.orderBy("window_start", "event_type")


@query("stream_sliding", _sliding_sql(15, 4, "event_type, COUNT(*) AS n", ", event_type"))
def stream_sliding(spark, sf):
    return _windowed(spark, sf, "1 hour", "15 minutes", ["event_type"], name="slide")


def _pane_windows(rows, key, measures, length, slide, name, kind="string"):
    """Sliding sums by panes as rows with window bounds."""
    out = PN.sliding_sums(rows, "ts", key, measures, length, slide)
    out = RN.run_to_table(out, "update", keys=["key", "start"], name=name)
    end = F.col("start") + F.lit(PN.micros(length))
    return out.select(F.timestamp_micros("start").cast("timestamp_ntz").alias("window_start"),
                      F.timestamp_micros(end).cast("timestamp_ntz").alias("window_end"),
                      F.col("key").cast(kind).alias(key), *measures)


@query("stream_sliding_sum", _sliding_sql(2, 5, "COUNT(*) AS n, ROUND(SUM(value), 6) AS total", ""))
def stream_sliding_sum(spark, sf):
    """Incremental sliding reduce (T7): sums by pane in the state; a window
    adds the pane that enters and subtracts the one that leaves."""
    s = ST.with_event_time(_event_stream(spark, sf), "ts", "1 hour").select(
        "ts", "event_type", F.lit(1.0).alias("n"), F.col("value").alias("total"))
    out = _pane_windows(s, "event_type", ["n", "total"], "10 minutes", "2 minutes", "slidesum")
    return out.groupBy("window_start", "window_end").agg(F.sum("n").cast("long").alias("n"),
                                                         F.round(F.sum("total"), 6).alias("total"))


@query("stream_sliding_fine", "WITH w AS (" + _sliding_sql(2, 300, "event_type, COUNT(*) AS n", ", event_type", unit="SECOND") + """)
SELECT event_type, COUNT(*) AS windows, CAST(SUM(n) AS BIGINT) AS n, CAST(SUM(n * n) AS BIGINT) AS squares, MAX(n) AS most FROM w GROUP BY event_type""")
def stream_sliding_fine(spark, sf):
    """T7 at ten minutes sliding by two seconds: 300 windows hold an event,
    which is kept in one pane. The windows are reported by event type."""
    s = ST.with_event_time(_event_stream(spark, sf), "ts", "1 hour").select("ts", "event_type", F.lit(1.0).alias("n"))
    out = _pane_windows(s, "event_type", ["n"], "10 minutes", "2 seconds", "slidefine")
    n = F.col("n").cast("long")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("windows"), F.sum(n).alias("n"),
                                         F.sum(n * n).alias("squares"), F.max(n).alias("most"))


def _pv_stream(spark, sf):
    return ST.with_event_time(C.page_views(SimpleNamespace(events=_event_stream(spark, sf))), "ts", "1 hour")


@query("stream_url_counts", _sliding_sql(2, 5, "url, COUNT(*) AS n", ", url", "pv", "WITH " + PV_SQL))
def stream_url_counts(spark, sf):
    g = ST.windowed_counts(_pv_stream(spark, sf), "ts", "10 minutes", "2 minutes", ["url"])
    g = g.select(*ST.window_bounds(), "url", "n")
    return RN.run_to_table(g, "update", keys=["window_start", "window_end", "url"], name="urls")


@query("stream_error_rate", "WITH " + PV_SQL + """, r AS (""" + _sliding_sql(
    10, 3, "zip, ROUND(AVG(CASE WHEN status <> 200 THEN 1.0 ELSE 0.0 END), 4) AS error_rate", ", zip", "pv") + """)
SELECT window_start, window_end, zip, error_rate,
       CASE WHEN error_rate > 0.05 THEN CAST(zip AS VARCHAR) || ': **' || CAST(error_rate AS VARCHAR) || '**'
            ELSE CAST(zip AS VARCHAR) || ': ' || CAST(error_rate AS VARCHAR) END AS line FROM r""")
def stream_error_rate(spark, sf):
    """Error rate per zip code over 30-minute windows sliding by 10, from
    panes of requests and errors."""
    return ST.with_error_line(_error_rate_panes(spark, sf, "30 minutes", "10 minutes"))


def _error_rate_panes(spark, sf, length, slide):
    views = _pv_stream(spark, sf).select("ts", "zip", F.lit(1.0).alias("n"),
                                         (F.col("status") != 200).cast("double").alias("bad"))
    out = _pane_windows(views, "zip", ["n", "bad"], length, slide, "errrate", "int")
    return out.select("window_start", "window_end", "zip", F.round(F.col("bad") / F.col("n"), 4).alias("error_rate"))


def _active_users(spark, sf, length, slide):
    changes = RN.run_to_table(PN.user_changes(_pv_stream(spark, sf), "ts", "user", length, slide), "append", name="active")
    end = F.col("start") + F.lit(PN.micros(length))
    return PN.users_by_window(changes.select("start", "change"), slide).select(
        F.timestamp_micros("start").cast("timestamp_ntz").alias("window_start"),
        F.timestamp_micros(end).cast("timestamp_ntz").alias("window_end"), "users")


@query("stream_active_users", _sliding_sql(5, 3, "CAST(COUNT(DISTINCT usr) AS BIGINT) AS users", "", "pv",
                                           "WITH " + PV_SQL))
def stream_active_users(spark, sf):
    """The stream keeps each user's active spans, one state row a user,
    and emits where they start and end; windows are running sums of that."""
    return _active_users(spark, sf, "15 minutes", "5 minutes")


@query("stream_batch_sql", f"""WITH {_LINES_SQL}
SELECT CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS batch, word, COUNT(*) AS n
FROM (SELECT lang, unnest(string_split(value, ' ')) AS word FROM lines) GROUP BY 1, 2""")
def stream_batch_sql(spark, sf):
    """SQL over each micro-batch through a temp view (T13): English texts
    arrive first, the rest after them."""
    docs = Tables(spark, sf).documents.select("text", "lang")
    parts = RN.Arrivals(docs, F.when(F.col("lang") == "en", 0).otherwise(1), "texts")
    run = scratch_path(spark, "view").rsplit("-", 1)[1]

    def per_batch(b, bid):
        view = f"batch_words_{run}_{bid}"
        ST.words(b).createOrReplaceTempView(view)
        return b.sparkSession.sql(f"SELECT {bid} AS batch, word, COUNT(*) AS n FROM {view} GROUP BY word")
    out = RN.run_to_table(_lines(parts.stream()), "append", name="batchsql", batch_fn=per_batch, arrivals=parts)
    return out.select(F.col("batch").cast("int").alias("batch"), "word", "n")


@query("stream_event_count", f"SELECT CAST({WEEK_SQL} AS INTEGER) AS batch, COUNT(*) AS n FROM events GROUP BY 1")
def stream_event_count(spark, sf):
    """Events received per batch."""
    weeks = _event_weeks(spark, sf)

    def per_batch(b, bid):
        return b.groupBy().agg(F.count(F.lit(1)).alias("n")).withColumn("batch", F.lit(bid))
    out = RN.run_to_table(weeks.stream(), "append", name="evcount", batch_fn=per_batch, arrivals=weeks)
    return out.select(F.col("batch").cast("int").alias("batch"), "n")


@query("stream_union_grep", f"""WITH {_LINES_SQL}
SELECT COUNT(*) AS n FROM lines WHERE contains(value, 'the')""")
def stream_union_grep(spark, sf):
    """Two line streams merged (T15, O7) and grepped."""
    a, b = RN.table_stream(spark, sf, "documents"), RN.table_stream(spark, sf, "documents")
    merged = _lines(a.filter("lang = 'en'")).union(_lines(b.filter("lang <> 'en'")))
    return RN.run_to_table(ST.grep_count(merged, "the"), "complete", name="grep")


# Stop words dropped from the word stream.
STREAM_STOPWORDS = ["the", "and", "de", "la", "le", "et", "der", "die", "und", "el", "y", ""]


@query("stream_stopword_drop", f"""WITH {_LINES_SQL}
SELECT word, COUNT(*) AS count FROM (SELECT unnest(string_split(value, ' ')) AS word FROM lines)
WHERE word NOT IN ({", ".join(f"'{w}'" for w in STREAM_STOPWORDS)}) GROUP BY word""")
def stream_stopword_drop(spark, sf):
    stop = spark.createDataFrame([(w,) for w in STREAM_STOPWORDS], "word string")
    kept = ST.drop_stopwords(ST.words(_line_stream(spark, sf)), stop)
    return RN.run_to_table(kept.groupBy("word").agg(F.count(F.lit(1)).alias("count")), "update", keys=["word"],
                           name="stop")


@query("stream_stopword_dropped", f"""WITH {_LINES_SQL},
w AS (SELECT word, word IN ({", ".join(f"'{w}'" for w in STREAM_STOPWORDS)}) AS dropped
      FROM (SELECT unnest(string_split(value, ' ')) AS word FROM lines))
SELECT CASE WHEN NOT dropped THEN word END AS word, dropped, COUNT(*) AS count FROM w GROUP BY 1, 2""")
def stream_stopword_dropped(spark, sf):
    """T16 with its counter: counts of kept words and of the rows dropped."""
    stop = spark.createDataFrame([(w,) for w in STREAM_STOPWORDS], "word string")
    both = ST.stopword_counts(ST.words(_line_stream(spark, sf)), stop)
    return RN.run_to_table(both, "update", keys=["word", "dropped"], name="stopcount")


@query("stream_static_join", "WITH " + PV_SQL + """
SELECT c.c_mktsegment, COUNT(*) AS n FROM pv JOIN customer c ON pv.usr = c.c_custkey GROUP BY 1""")
def stream_static_join(spark, sf):
    """Stream–static inner join (J13, T18); the planner picks the static
    side's strategy from its size estimate."""
    pv = C.page_views(SimpleNamespace(events=_event_stream(spark, sf)))
    cust = Tables(spark, sf).customer.select(F.col("c_custkey").alias("user"), "c_mktsegment")
    g = pv.join(cust, "user").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return RN.run_to_table(g, "update", keys=["c_mktsegment"], name="ssjoin")


@query("stream_modulo_count", "SELECT user_id % 10 AS bucket, COUNT(*) AS n FROM events GROUP BY 1")
def stream_modulo_count(spark, sf):
    """Queue of batches (T19): one week of events per trigger."""
    weeks = _event_weeks(spark, sf)
    return RN.run_to_table(ST.modulo_counts(weeks.stream(), "user_id"), "update", keys=["bucket"], name="modulo",
                           arrivals=weeks)


# ---- online statistics and models (T21, T24) ----------------------------------

@query("welch_test", """
WITH g AS (SELECT event_type AS grp, COUNT(*) AS n, AVG(value) AS m, VAR_SAMP(value) AS v FROM events
           WHERE event_type IN ('click', 'view') GROUP BY 1),
a AS (SELECT * FROM g WHERE grp = 'click'), b AS (SELECT * FROM g WHERE grp = 'view')
SELECT ROUND((a.m - b.m) / SQRT(a.v / a.n + b.v / b.n), 6) AS t,
       ROUND(POW(a.v / a.n + b.v / b.n, 2) / (POW(a.v / a.n, 2) / (a.n - 1) + POW(b.v / b.n, 2) / (b.n - 1)), 6) AS df
FROM a, b""")
def welch_test(spark, sf):
    """Cumulative per-group moments maintained by a streaming aggregate
    (complete mode); the Welch statistic is computed on the final two rows."""
    from ..streaming.online import group_moments, welch_columns
    s = _event_stream(spark, sf)
    s = s.filter(F.col("event_type").isin("click", "view"))
    mom = RN.run_to_table(group_moments(s, "event_type", "value"), "complete", name="welch")
    w = welch_columns(mom, "event_type", "click", "view")
    return w.select(F.round("t", 6).alias("t"), F.round("df", 6).alias("df"))


def _run_model(spark, arrivals, model_of, done=None):
    """Drain arrivals into a model that is stored next to the checkpoint."""
    ckpt = scratch_path(spark, "online-model")
    model = model_of(ON.ModelStore(spark, f"{ckpt}/model"))

    def start():
        return (arrivals.stream().writeStream.foreachBatch(lambda b, bid: model.update(b, bid))
                .option("checkpointLocation", f"{ckpt}/query").trigger(availableNow=True).start())
    RN.drain(start, arrivals, (lambda: model.done()) if done else None)
    return model


KMEANS_K, KMEANS_SLICES = 3, 4


def _kmeans_sql() -> str:
    """The same updates, one CTE chain per slice."""
    u = hash_unit_sql("vec_id", 9)
    parts = [f"""e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, {u} AS u,
  LEAST(CAST(FLOOR({u} * {KMEANS_SLICES}) AS INTEGER), {KMEANS_SLICES - 1}) AS slice FROM embeddings)""",
             f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY u) - 1 AS INTEGER) AS k, x AS c, 0.0::DOUBLE AS w
  FROM e ORDER BY u LIMIT {KMEANS_K})"""]
    for i in range(KMEANS_SLICES):
        parts += [
            f"a{i} AS (SELECT vec_id, any_value(x) AS x, arg_min(k, list_distance(x, c)) AS k FROM e, c{i} WHERE slice = {i} GROUP BY vec_id)",
            f"d{i} AS (SELECT k, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM a{i})",
            f"s{i} AS (SELECT k, list(v ORDER BY j) AS s FROM (SELECT k, j, SUM(v) AS v FROM d{i} GROUP BY k, j) GROUP BY k)",
            f"n{i} AS (SELECT k, COUNT(*) AS n FROM a{i} GROUP BY k)",
            f"""c{i + 1} AS (SELECT c.k, CASE WHEN n IS NULL THEN c.c
   ELSE list_transform(range(1, len(c.c) + 1), lambda j: (c.c[j] * c.w + s.s[j]) / (c.w + n)) END AS c,
   c.w + COALESCE(n, 0) AS w FROM c{i} c LEFT JOIN s{i} s ON s.k = c.k LEFT JOIN n{i} m ON m.k = c.k)"""]
    return "WITH " + ",\n".join(parts) + f"""
SELECT k AS cluster, w AS weight, generate_subscripts(c, 1) - 1 AS dim, ROUND(unnest(c), 6) AS value FROM c{KMEANS_SLICES}"""


@query("stream_kmeans", _kmeans_sql())
def stream_kmeans(spark, sf):
    """Streaming k-means (decay 1.0) over embeddings that arrive in four
    slices, from the three rows of smallest hash; centres and weights."""
    e = Tables(spark, sf).embeddings.select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    u = hash_unit("vec_id", 9)
    init = [r.x for r in e.orderBy(u).limit(KMEANS_K).collect()]  # k starting centres
    parts = RN.Arrivals(e, F.least(F.floor(u * KMEANS_SLICES), F.lit(KMEANS_SLICES - 1)), "vectors")
    km = _run_model(spark, parts, lambda store: ON.StreamingKMeans(init, decay=1.0, store=store))
    rows = [(i, float(w), j, round(v, 6)) for i, (w, c) in enumerate(zip(km.weights, km.centers)) for j, v in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, weight double, dim long, value double")


@query("stream_kmeans_predict", _kmeans_sql().rsplit("\nSELECT", 1)[0] + f"""
SELECT vec_id, arg_min(k, list_distance(x, c)) AS cluster FROM e, c{KMEANS_SLICES} GROUP BY vec_id""")
def stream_kmeans_predict(spark, sf):
    """The trained centres applied to a second stream."""
    e = Tables(spark, sf).embeddings.select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    u = hash_unit("vec_id", 9)
    init = [r.x for r in e.orderBy(u).limit(KMEANS_K).collect()]
    parts = RN.Arrivals(e, F.least(F.floor(u * KMEANS_SLICES), F.lit(KMEANS_SLICES - 1)), "vectors")
    km = _run_model(spark, parts, lambda store: ON.StreamingKMeans(init, decay=1.0, store=store))
    second = RN.table_stream(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    return RN.run_to_table(km.assign(second).select("vec_id", "cluster"), "append", name="km-predict").select(
        "vec_id", "cluster")


@query("stream_stateful_count", """
WITH seen AS (SELECT CAST(user_id AS VARCHAR) AS key, COUNT(*) AS c FROM events GROUP BY 1),
init AS (SELECT CAST(o_custkey AS VARCHAR) AS key, COUNT(*) AS c FROM orders
         WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1)
SELECT s.key, CAST(s.c + COALESCE(i.c, 0) AS BIGINT) AS count FROM seen s LEFT JOIN init i ON s.key = i.key""")
def stream_stateful_count(spark, sf):
    """Running event count per user over the event stream, seeded with
    each customer's order count since 2001 as the initial state. Output is
    the latest count of every user the stream touched."""
    from ..streaming.stateful import running_counts
    o = Tables(spark, sf).orders
    init = (o.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
             .groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("count")))
    out = running_counts(_event_stream(spark, sf), "user_id", init)
    return RN.run_to_table(out, "update", keys=["key"], name="stateful")


SGD_SLICES, SGD_STEP = 4, 0.5
LINEAR_STEPS, LOGISTIC_STEPS = 50, 3


def _sgd_rows(t, logistic: bool):
    label = (F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0) if logistic
             else F.col("l_extendedprice") / 100000)
    return t.lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"),
                             F.array(F.col("l_quantity") / 50, F.col("l_discount") * 10,
                                     F.col("l_tax") * 10).alias("x"), label.alias("y"))


def _sgd_sql(logistic: bool) -> str:
    """The same gradient steps. Least squares iterates on second moments (a
    recursive CTE per slice); logistic steps are unrolled over the rows."""
    u = hash_unit_sql("l_orderkey * 8 + l_linenumber", 13)
    y = "CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE" if logistic else "l_extendedprice / 100000"
    parts = [f"""d AS (SELECT l_orderkey * 8 + l_linenumber AS k, l_quantity / 50 AS x0, l_discount * 10 AS x1, l_tax * 10 AS x2,
  {y} AS y, LEAST(CAST(FLOOR({u} * {SGD_SLICES}) AS INTEGER), {SGD_SLICES - 1}) AS slice FROM lineitem)""",
             "w0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c, 0.0::DOUBLE AS o)"]
    n = 0
    for s in range(SGD_SLICES):
        if logistic:
            for i in range(1, LOGISTIC_STEPS + 1):
                parts.append(f"""g{n} AS (SELECT COUNT(*) AS n, SUM(e * x0) AS ga, SUM(e * x1) AS gb, SUM(e * x2) AS gc, SUM(e) AS go
  FROM (SELECT x0, x1, x2, 1 / (1 + EXP(-(a * x0 + b * x1 + c * x2 + o))) - y AS e FROM d, w{n} WHERE slice = {s}))""")
                z = f"({SGD_STEP} / SQRT({i}))"
                parts.append(f"w{n + 1} AS (SELECT a - {z} * ga / n AS a, b - {z} * gb / n AS b, c - {z} * gc / n AS c, "
                             f"o - {z} * go / n AS o FROM w{n}, g{n})")
                n += 1
        else:
            parts.append(f"""m{s} AS (SELECT COUNT(*) AS n, SUM(x0*x0) AS aa, SUM(x0*x1) AS ab, SUM(x0*x2) AS ac, SUM(x1*x1) AS bb,
  SUM(x1*x2) AS bc, SUM(x2*x2) AS cc, SUM(x0) AS ao, SUM(x1) AS bo, SUM(x2) AS co,
  SUM(x0*y) AS ya, SUM(x1*y) AS yb, SUM(x2*y) AS yc, SUM(y) AS yo FROM d WHERE slice = {s})""")
            z = f"({SGD_STEP} / SQRT(i + 1) / n)"
            parts.append(f"""r{s} AS (SELECT 0 AS i, a, b, c, o FROM w{s} UNION ALL
  SELECT i + 1, a - {z} * (aa*a + ab*b + ac*c + ao*o - ya), b - {z} * (ab*a + bb*b + bc*c + bo*o - yb),
         c - {z} * (ac*a + bc*b + cc*c + co*o - yc), o - {z} * (ao*a + bo*b + co*c + n*o - yo)
  FROM r{s}, m{s} WHERE i < {LINEAR_STEPS})""")
            parts.append(f"w{s + 1} AS (SELECT a, b, c, o FROM r{s} WHERE i = {LINEAR_STEPS})")
            n = s + 1
    margin = "a * x0 + b * x1 + c * x2 + o"
    pred = f"1 / (1 + EXP(-({margin})))" if logistic else margin
    return "WITH RECURSIVE " + ",\n".join(parts) + f"""
SELECT k, y, ROUND({pred}, 4) AS prediction FROM d, w{n}"""


def _sgd_stream(spark, sf, logistic: bool):
    d = _sgd_rows(Tables(spark, sf), logistic)
    parts = RN.Arrivals(d, F.least(F.floor(hash_unit("k", 13) * SGD_SLICES), F.lit(SGD_SLICES - 1)), "sgd")
    steps = LOGISTIC_STEPS if logistic else LINEAR_STEPS
    model = _run_model(spark, parts, lambda store: ON.StreamingSGD(3, SGD_STEP, logistic, steps, store))
    # predictions on a second stream
    second = _sgd_rows(SimpleNamespace(lineitem=RN.table_stream(spark, sf, "lineitem")), logistic)
    scored = second.select("k", "y", F.round(model.predict_col("x"), 4).alias("prediction"))
    return RN.run_to_table(scored, "append", name="sgd-predict").select("k", "y", "prediction")


@query("stream_linreg", _sgd_sql(False))
def stream_linreg(spark, sf):
    """Streaming least squares, then predictions on a second stream."""
    return _sgd_stream(spark, sf, logistic=False)


@query("stream_logreg", _sgd_sql(True))
def stream_logreg(spark, sf):
    """Streaming logistic regression, then probabilities on a second stream."""
    return _sgd_stream(spark, sf, logistic=True)


def _dashboard_run(spark, sf, metric, keys):
    users = Tables(spark, sf).customer.select(F.col("c_custkey").alias("user"), F.col("c_name").alias("name"))
    g = ST.dashboard(_pv_stream(spark, sf), metric, users)
    if "w" in g.columns:
        g = g.select(*ST.window_bounds(), *[c for c in g.columns if c not in ("w", "line")])
    return RN.run_to_table(g, "update" if keys else "append", keys=keys, name=f"dash-{metric}")


@query("clickstream_dashboard", "WITH " + PV_SQL + """
SELECT DISTINCT pv.usr AS user, c.c_name AS name FROM pv JOIN customer c ON pv.usr = c.c_custkey""")
def clickstream_dashboard(spark, sf):
    """``popularUsersSeen``, users of the stream found in the customer table."""
    return _dashboard_run(spark, sf, "popularUsersSeen", None).select("user", "name").dropDuplicates(["user"])


@query("clickstream_page_counts", "WITH " + PV_SQL + " SELECT url, COUNT(*) AS n FROM pv GROUP BY url")
def clickstream_page_counts(spark, sf):
    """``pageCounts``."""
    return _dashboard_run(spark, sf, "pageCounts", ["url"])


@query("clickstream_sliding_pages", _sliding_sql(2, 5, "url, COUNT(*) AS n", ", url", "pv", "WITH " + PV_SQL, "SECOND"))
def clickstream_sliding_pages(spark, sf):
    """``slidingPageCounts``."""
    return _dashboard_run(spark, sf, "slidingPageCounts", ["window_start", "window_end", "url"])


@query("clickstream_error_rate", _sliding_sql(
    2, 15, "zip, ROUND(AVG(CASE WHEN status <> 200 THEN 1.0 ELSE 0.0 END), 4) AS error_rate", ", zip", "pv",
    "WITH " + PV_SQL, "SECOND"))
def clickstream_error_rate(spark, sf):
    """``errorRatePerZipCode``, 30 seconds by 2, from panes."""
    return _error_rate_panes(spark, sf, "30 seconds", "2 seconds")


@query("clickstream_active_users", f"""WITH {PV_SQL},
s AS (SELECT DISTINCT epoch_us(ts) // 1000000 AS sec, usr FROM pv),
w AS (SELECT DISTINCT (sec // 2 - i) * 2 AS start, usr FROM s, range(8) r(i) WHERE sec < (sec // 2 - i) * 2 + 15)
SELECT make_timestamp(CAST(start * 1000000 AS BIGINT)) AS window_start,
       make_timestamp(CAST((start + 15) * 1000000 AS BIGINT)) AS window_end, COUNT(*) AS users FROM w GROUP BY start""")
def clickstream_active_users(spark, sf):
    """``activeUserCount``, 15 seconds by 2, from the users' spans."""
    return _active_users(spark, sf, "15 seconds", "2 seconds")


@query("welch_stream_stop", f"""
WITH e AS (SELECT {WEEK_SQL} AS batch, event_type AS g, value AS v FROM events WHERE event_type IN ('click', 'view')),
s AS (SELECT batch, g, COUNT(*) AS n, SUM(v) AS s, SUM(v * v) AS q FROM e GROUP BY 1, 2),
c AS (SELECT batch, g, SUM(n) OVER w AS n, SUM(s) OVER w AS s, SUM(q) OVER w AS q FROM s
      WINDOW w AS (PARTITION BY g ORDER BY batch)),
v AS (SELECT batch, g, n, s / n AS m, (q - s * s / n) / (n - 1) / n AS se FROM c)
SELECT CAST(a.batch AS BIGINT) AS batch, ROUND((a.m - b.m) / SQRT(a.se + b.se), 6) AS t,
       ROUND(POW(a.se + b.se, 2) / (POW(a.se, 2) / (a.n - 1) + POW(b.se, 2) / (b.n - 1)), 4) AS df
FROM v a JOIN v b ON a.batch = b.batch AND a.g = 'click' AND b.g = 'view'""")
def welch_stream_stop(spark, sf):
    """T24 with its stopping rule: one week of events per micro-batch; the
    query is not run again once p < 0.05 (or after 10 batches). Returns the
    test per batch; on these tables the rule does not fire (the twin has all
    weeks), the stop itself is tested on planted data."""
    weeks = _event_weeks(spark, sf)
    w = _run_model(spark, weeks, lambda store: ON.StreamingWelch(
        "event_type", "value", "click", "view", alpha=0.05, max_batches=10, store=store), done=True)
    rows = [(b, round(t, 6), round(df, 4)) for b, t, df, _ in w.history]
    return spark.createDataFrame(rows, "batch long, t double, df double")
