"""The engine's operators over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.functions import dates, keys, policy, text
from lumbre.operators import dedup, joins, limits, reconcile
from lumbre.plans import planner
from lumbre.sources import sinks

_Q: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f):
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- export and joins -----------------------------------------------------------------


@_query("""
WITH d AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
SELECT o_orderkey, o_orderstatus AS tipo, o_orderpriority AS formato, strftime(o_orderdate, '%d/%m/%Y') AS data,
       CASE WHEN d.l_orderkey IS NOT NULL THEN 'pdf/' || d.l_partkey || '.pdf' END AS arquivo_local
FROM orders LEFT JOIN d ON d.l_orderkey = o_orderkey AND rn = 1
""")
def export_documents(spark, sf_dir):
    """Documents (orders) with the path of their latest download (lineitem)."""
    orders = _t(spark, sf_dir, "orders")
    log = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    latest = joins.with_latest(orders, log, "o_orderkey", ["l_linenumber"], "l_partkey", "_part")
    path = F.when(F.col("_part").isNotNull(), F.concat(F.lit("pdf/"), F.col("_part").cast("string"), F.lit(".pdf")))
    return latest.select("o_orderkey", F.col("o_orderstatus").alias("tipo"), F.col("o_orderpriority").alias("formato"), dates.format_date(F.col("o_orderdate")).alias("data"), path.alias("arquivo_local"))


@_query("""
SELECT c_custkey, c_name, c_mktsegment, CAST(count(o_orderkey) AS BIGINT) AS qtd_documentos,
       CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS qtd_movimentacoes
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL
""")
def export_cases(spark, sf_dir):
    """Cases (customers) with the sizes of their nested parts."""
    counted = _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("d"), F.countDistinct("o_orderpriority").alias("m"))
    zero = F.lit(0).cast("long")
    return _t(spark, sf_dir, "customer").join(counted, "c_custkey", "left").select("c_custkey", "c_name", "c_mktsegment", F.coalesce("d", zero).alias("qtd_documentos"), F.coalesce("m", zero).alias("qtd_movimentacoes"))


@_query("""
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 200000)
  AND NOT EXISTS (SELECT 1 FROM supplier s WHERE 'Customer' || substr(s.s_name, 9) = c.c_name)
""")
def unseen_cases(spark, sf_dir):
    """Cases seen neither by key nor by number."""
    seen = _t(spark, sf_dir, "orders").filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"), F.lit(None).cast("string").alias("c_name"))
    named = _t(spark, sf_dir, "supplier").select(F.lit(None).cast("long").alias("c_custkey"), F.concat(F.lit("Customer"), F.substr("s_name", F.lit(9))).alias("c_name"))
    return joins.unseen(_t(spark, sf_dir, "customer").select("c_custkey", "c_name"), seen.unionByName(named), ["c_custkey", "c_name"])


@_query("SELECT p_partkey, p_name FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)")
def existing_semi(spark, sf_dir):
    files = _t(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return joins.existing(_t(spark, sf_dir, "part").select("p_partkey", "p_name"), files, ["p_partkey"])


@_query("SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)")
def pending_anti(spark, sf_dir):
    done = _t(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return joins.not_in(_t(spark, sf_dir, "part").select("p_partkey", "p_name"), done, ["p_partkey"])


@_query("SELECT n_name, o_orderpriority FROM nation CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders)")
def cross_fanout(spark, sf_dir):
    return joins.fan_out(_t(spark, sf_dir, "nation").select("n_name"), _t(spark, sf_dir, "orders").select("o_orderpriority").distinct())


@_query("""
SELECT event_id, (SELECT max_by(t.value, (t.ts, t.event_id)) FROM events t
                  WHERE t.event_type = 'purchase' AND t.user_id = e.user_id AND t.ts <= e.ts) AS total_before
FROM events e WHERE e.event_type <> 'purchase'
""")
def asof_total(spark, sf_dir):
    """The last total at or before each event of its user."""
    events = _t(spark, sf_dir, "events").withColumn("pos", F.unix_micros(F.col("ts").cast("timestamp")))
    totals = events.filter("event_type = 'purchase'").groupBy("user_id", "pos").agg(F.max_by("value", "event_id").alias("value"))
    asked = events.filter("event_type != 'purchase'").select("event_id", "user_id", "pos")
    return joins.asof_backward(asked, totals, ["user_id"], "pos", "value", "total_before", width=7 * 86_400_000_000).select("event_id", "total_before")


@_query("""
SELECT r_name, min_by(n_name, n_nationkey) AS n_name FROM nation JOIN (SELECT DISTINCT right(n_name, 1) AS r_name FROM nation WHERE n_nationkey < 15) ON n_name LIKE '%' || r_name GROUP BY r_name
""")
def suffix_roles(spark, sf_dir):
    roles = _t(spark, sf_dir, "nation").filter("n_nationkey < 15").select(F.right("n_name", F.lit(1)).alias("r_name")).distinct()
    return joins.suffix_match(roles, _t(spark, sf_dir, "nation"), "r_name", "n_name", "n_nationkey")


@_query("""
SELECT 'ativo' AS polo, c_name AS nome FROM customer UNION ALL SELECT 'passivo', s_name FROM supplier UNION ALL SELECT 'outros', n_name FROM nation
""")
def union_panels(spark, sf_dir):
    parts = [("customer", "c_name", "ativo"), ("supplier", "s_name", "passivo"), ("nation", "n_name", "outros")]
    a, b, c = (_t(spark, sf_dir, t).select(F.lit(polo).alias("polo"), F.col(n).alias("nome")) for t, n, polo in parts)
    return a.unionByName(b).unionByName(c)


# --- planning -------------------------------------------------------------------------

_PLAN_SQL = """
WITH RECURSIVE h AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS k, count(*) AS n FROM orders GROUP BY 1, 2),
u AS (SELECT d, k, sum(n) OVER (PARTITION BY k ORDER BY d) AS upto FROM h),
b AS (SELECT min(d) AS lo, max(d) AS hi FROM h), ks AS (SELECT DISTINCT k FROM h),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
g AS (SELECT days.d, ks.k, coalesce((SELECT max(upto) FROM u WHERE u.k = ks.k AND u.d <= days.d), 0) AS upto FROM days, ks),
w AS (SELECT d, CAST(NULL AS VARCHAR) AS k, sum(upto) AS upto FROM g GROUP BY d UNION ALL SELECT d, k, upto FROM g),
c AS (
  SELECT lo AS a, hi AS z, CAST(NULL AS VARCHAR) AS k, 0 AS depth,
         CAST((SELECT upto FROM w WHERE w.k IS NULL AND w.d = hi) AS BIGINT) AS n FROM b
  UNION ALL
  SELECT x.a, x.z, x.k, c.depth + 1,
         CAST((SELECT upto FROM w WHERE w.k IS NOT DISTINCT FROM x.k AND w.d = x.z)
            - coalesce((SELECT upto FROM w WHERE w.k IS NOT DISTINCT FROM x.k AND w.d = x.a - 1), 0) AS BIGINT)
  FROM c, LATERAL (
    SELECT c.a AS a, c.a + CAST((c.z - c.a + 1) // 2 - 1 AS INTEGER) AS z, c.k AS k WHERE c.z > c.a
    UNION ALL SELECT c.a + CAST((c.z - c.a + 1) // 2 AS INTEGER), c.z, c.k WHERE c.z > c.a
    UNION ALL SELECT c.a, c.z, ks.k FROM ks WHERE c.z = c.a AND c.k IS NULL) x
  WHERE c.n >= {cap}),
p AS (SELECT a AS start, z AS "end", k AS class, false AS unclassed, depth, n,
       CASE WHEN n < {cap} THEN 'COMPLETE' WHEN z > a OR k IS NULL THEN 'SUBDIVIDED' ELSE 'SATURATED' END AS status FROM c)
"""


def _plan(spark, sf_dir, cap):
    return planner.plan_cells(_t(spark, sf_dir, "orders"), "o_orderdate", "o_orderpriority", cap)


@_query(_PLAN_SQL.format(cap=30) + "SELECT * FROM p")
def plan_cells_cap30(spark, sf_dir):
    return _plan(spark, sf_dir, 30)


@_query(_PLAN_SQL.format(cap=5) + "SELECT * FROM p")
def plan_cells_cap5(spark, sf_dir):
    return _plan(spark, sf_dir, 5)


@_query(_PLAN_SQL.format(cap=3) + "SELECT start, class, n FROM p WHERE status = 'SATURATED'")
def saturated_cells(spark, sf_dir):
    return _plan(spark, sf_dir, 3).filter("status = 'SATURATED'").select("start", "class", "n")


@_query(_PLAN_SQL.format(cap=3) + """
SELECT o_orderkey, status FROM (
  SELECT o_orderkey, p.status, row_number() OVER (PARTITION BY p.start, p."end", p.class ORDER BY o_orderkey) AS rn
  FROM orders JOIN p ON CAST(o_orderdate AS DATE) BETWEEN p.start AND p."end" AND (p.class IS NULL OR p.class = o_orderpriority)
  WHERE p.status <> 'SUBDIVIDED') WHERE status = 'COMPLETE' OR rn <= 3
""")
def harvest_capped(spark, sf_dir):
    """What a planned crawl under a cap of three gets to see, and whether its cell was whole."""
    orders = _t(spark, sf_dir, "orders")
    return planner.harvest(orders, _plan(spark, sf_dir, 3), "o_orderdate", "o_orderpriority", ["o_orderkey"], 3).select("o_orderkey", "status")


@_query("SELECT o_custkey, CAST(count(*) AS BIGINT) AS n, CAST(least(count(*), 10) AS BIGINT) AS shown, count(*) >= 10 AS capped FROM orders GROUP BY o_custkey")
def capped_searches(spark, sf_dir):
    n = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return n.select("o_custkey", "n", limits.capped(F.col("n"), 10).cast("long").alias("shown"), limits.at_server_cap(F.col("n"), F.lit(False), 10).alias("capped"))


@_query("""
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') AS inicio, CAST(o_orderdate AS DATE) AS first_start,
  CAST(o_orderdate AS DATE) + CAST((o_orderkey % 40 + 1) // 2 - 1 AS INTEGER) AS first_end,
  CAST(o_orderdate AS DATE) + CAST((o_orderkey % 40 + 1) // 2 AS INTEGER) AS second_start,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS second_end
FROM orders WHERE o_orderkey % 40 > 0
""")
def window_split(spark, sf_dir):
    """Date ranges in two inclusive halves; ranges of one day have none."""
    start = F.col("o_orderdate").cast("date")
    end = F.date_add(start, (F.col("o_orderkey") % 40).cast("int"))
    halves = _t(spark, sf_dir, "orders").select("o_orderkey", dates.format_date(start).alias("inicio"), dates.split_range(start, end).alias("h"))
    return halves.filter("h IS NOT NULL").select("o_orderkey", "inicio", "h.*")


@_query("""
SELECT o_orderkey, 'classeJudicial=' || o_orderpriority || '|dataFim=' || strftime(o_orderdate, '%d/%m/%Y') || CASE WHEN o_orderstatus <> 'O' THEN '|ufOAB=' || o_orderstatus ELSE '' END AS cell_key FROM orders
""")
def cell_key(spark, sf_dir):
    blank = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).otherwise("")
    criteria = F.struct(F.lit(None).cast("string").alias("nomeParte"), blank.alias("ufOAB"), F.col("o_orderpriority").alias("classeJudicial"), dates.format_date(F.col("o_orderdate")).alias("dataFim"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", keys.cell_key(criteria, ["nomeParte", "ufOAB", "classeJudicial", "dataFim"]).alias("cell_key"))


# --- dedup, upsert, limits, reconciliation ----------------------------------------------


@_query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1")
def first_wins_dedup(spark, sf_dir):
    return dedup.first_wins(_t(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@_query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def last_wins_dedup(spark, sf_dir):
    return dedup.last_wins(_t(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@_query("""
WITH e AS (SELECT user_id, event_id, event_type AS rotulo, CASE WHEN event_id % 3 = 0 THEN 'u' || event_id END AS "downloadUrl",
                  CASE WHEN event_id % 3 = 0 THEN 'pdf' ELSE 'html' END AS formato, CASE WHEN event_id % 2 = 0 THEN 'b' || event_id END AS "idBin" FROM events),
a AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
b AS (SELECT * FROM e WHERE "downloadUrl" IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)
SELECT a.user_id, a.event_id, a.rotulo, coalesce(a."downloadUrl", b."downloadUrl") AS "downloadUrl",
       CASE WHEN a."downloadUrl" IS NULL AND b.user_id IS NOT NULL THEN b.formato ELSE a.formato END AS formato,
       CASE WHEN a."downloadUrl" IS NULL AND b.user_id IS NOT NULL THEN coalesce(b."idBin", a."idBin") ELSE a."idBin" END AS "idBin"
FROM a LEFT JOIN b USING (user_id)
""")
def dedupe_upgrade(spark, sf_dir):
    i = F.col("event_id")
    rows = _t(spark, sf_dir, "events").select(
        "user_id", "event_id", F.col("event_type").alias("rotulo"), F.when(i % 3 == 0, F.concat(F.lit("u"), i.cast("string"))).alias("downloadUrl"),
        F.when(i % 3 == 0, "pdf").otherwise("html").alias("formato"), F.when(i % 2 == 0, F.concat(F.lit("b"), i.cast("string"))).alias("idBin"),
    )
    return dedup.upgrade_documents(rows, "user_id", "event_id", F.col("downloadUrl").isNotNull(), if_set=("idBin",))


@_query("SELECT user_id, coalesce(max_by(event_type, event_id) FILTER (WHERE event_id % 4 <> 0), '') AS valor FROM events GROUP BY user_id")
def non_empty_wins(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_id") % 4 != 0, F.col("event_type")).otherwise("").alias("valor"))
    return dedup.non_empty_wins(rows, ["user_id"], "valor", "event_id")


@_query("""
SELECT 'detail:' || user_id AS key, max_by(props, event_id) AS error, max(ts) AS "lastAttemptAt", CAST(count(*) AS BIGINT) AS attempts
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events WHERE event_type = 'error') GROUP BY user_id
""")
def failure_upsert(spark, sf_dir):
    errors = _t(spark, sf_dir, "events").filter("event_type = 'error'")
    rows = errors.select(F.concat(F.lit("detail:"), F.col("user_id").cast("string")).alias("key"), F.col("props").alias("error"), F.col("event_id").alias("seq"))
    last = errors.groupBy(F.concat(F.lit("detail:"), F.col("user_id").cast("string")).alias("key")).agg(F.max("ts").alias("lastAttemptAt"))
    return dedup.upsert_failures(rows).join(last, "key").select("key", "error", "lastAttemptAt", "attempts")


@_query("""
SELECT 'k' || user_id AS key FROM (SELECT DISTINCT user_id FROM events WHERE event_type = 'error')
WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 90)
""")
def failures_cleared(spark, sf_dir):
    key = F.concat(F.lit("k"), F.col("user_id").cast("string")).alias("key")
    events = _t(spark, sf_dir, "events")
    return dedup.clear_failures(events.filter("event_type = 'error'").select(key).distinct(), events.filter("event_type = 'purchase' AND value > 90").select(key))


@_query("SELECT user_id, event_type FROM events GROUP BY ALL")
def distinct_keys(spark, sf_dir):
    return dedup.distinct_keys(_t(spark, sf_dir, "events"), ["user_id", "event_type"])


@_query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem WHERE l_returnflag = 'R') WHERE rn <= 2
""")
def topk_per_case(spark, sf_dir):
    """At most two downloads a case, in document order."""
    rows = _t(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return limits.top_per_group(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], 2)


@_query("""
WITH n AS (SELECT l_orderkey, count(*) AS rows_read FROM lineitem GROUP BY 1),
p AS (SELECT l_orderkey, rows_read, 1 + rows_read // 3 AS last_page, CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END AS failed,
             CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN rows_read + 1 ELSE rows_read END AS footer FROM n)
SELECT o_orderkey, CAST(CASE WHEN last_page > 1 THEN last_page ELSE 1 END AS BIGINT) AS pages,
  CAST(CASE WHEN last_page > 1 THEN last_page - failed ELSE 1 END AS BIGINT) AS pages_read, CAST(CASE WHEN last_page > 1 THEN failed ELSE 0 END AS BIGINT) AS pages_failed,
  CASE WHEN last_page > 1 THEN failed = 0 AND (footer IS NULL OR footer = rows_read) ELSE NOT (o_orderkey % 2 = 0 AND l_orderkey IS NULL) END AS complete
FROM orders LEFT JOIN p ON l_orderkey = o_orderkey
""")
def reconcile_panels(spark, sf_dir):
    k = F.col("l_orderkey")
    n = _t(spark, sf_dir, "lineitem").groupBy(k).agg(F.count("*").alias("rows_read"))
    failed = F.when(k % 5 == 0, 1).otherwise(0)
    last = 1 + F.floor(F.col("rows_read") / 3)
    panels = n.select(
        k.alias("o_orderkey"), last.alias("last_page"), (last - failed).alias("pages_read"), failed.cast("long").alias("pages_failed"), "rows_read",
        F.when(k % 7 == 0, None).when(k % 3 == 0, F.col("rows_read") + 1).otherwise(F.col("rows_read")).alias("footer"),
    )
    cases = _t(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 2 == 0).alias("has_slider"))
    return reconcile.reconcile_panels(cases, panels, "o_orderkey").drop("strict")


@_query("""
SELECT l_orderkey, CAST(page AS BIGINT) AS page FROM (SELECT l_orderkey, unnest(generate_series(2, 1 + count(*) // 2)) AS page FROM lineitem GROUP BY l_orderkey)
""")
def remaining_pages(spark, sf_dir):
    pagers = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.lit(1).cast("long").alias("currentPage"), (1 + F.floor(F.count("*") / 2)).alias("lastPage"))
    return limits.remaining_pages(pagers).select("l_orderkey", "page")


@_query("""
SELECT event_type, CAST(count(*) AS BIGINT) AS requests, CAST(count(*) FILTER (WHERE value > 50) AS BIGINT) AS large, round(sum(value), 2) AS total, CAST(count(DISTINCT user_id) AS BIGINT) AS users FROM events GROUP BY event_type
""")
def run_summary(spark, sf_dir):
    return _t(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("requests"), F.count_if(F.col("value") > 50).alias("large"), F.round(F.sum("value"), 2).alias("total"), F.countDistinct("user_id").alias("users"))


@_query("""
WITH s AS (SELECT *, sum(CASE WHEN event_type NOT IN ('error', 'view') THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM events)
SELECT event_id, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY event_id) AS BIGINT) AS run FROM s
""")
def consecutive_errors(spark, sf_dir):
    """Length of the run of refusals at each request; views neither add to a run nor end it."""
    kind = F.col("event_type")
    return policy.refusal_runs(_t(spark, sf_dir, "events"), ["user_id"], ["event_id"], kind == "error", ~kind.isin("error", "view")).select("event_id", "run")


# --- scalar functions -------------------------------------------------------------------


@_query(r"""
SELECT doc_id, trim(regexp_replace(text, '[\t\n\x0B\f\r \x{00A0}]+', ' ', 'g')) AS limpo FROM documents
""")
def collapse_ws(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.collapse_spaces(F.col("text")).alias("limpo"))


@_query("SELECT doc_id, strip_accents(text) AS sem_acentos FROM documents")
def clean_text(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.deaccent(F.col("text")).alias("sem_acentos"))


@_query(r"""
SELECT doc_id, coalesce(nullif(lower(substr(regexp_replace(regexp_replace(strip_accents(text), '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80)), ''), 'documento') AS slug FROM documents
""")
def slug_text(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.slugify(F.col("text")).alias("slug"))


@_query(r"""
SELECT p_partkey, nullif(regexp_extract(p_type || ' (' || p_brand || ')', '\(([^()]+)\)\s*$', 1), '') AS papel,
       nullif(regexp_extract('CNPJ: ' || p_partkey || '/0001-10 x', '(?i)\b(?:CPF|CNPJ)\s*:\s*([\d./-]+)', 1), '') AS documento,
       '4,' || lpad(CAST(p_size AS VARCHAR), 2, '0') || ' Kb' AS tamanho, CAST(round((4 + p_size / 100.0) * 1024) AS BIGINT) AS bytes
FROM part
""")
def party_fields(spark, sf_dir):
    """Trailing parentheses, taxpayer ids and size texts."""
    size = F.concat(F.lit("4,"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit(" Kb"))
    part = _t(spark, sf_dir, "part").withColumn("tamanho", text.size_text(F.concat(F.lit("x ("), size, F.lit(")"))))
    return part.select(
        "p_partkey", text.trailing_parentheses(F.concat("p_type", F.lit(" ("), "p_brand", F.lit(")"))).alias("papel"),
        text.taxpayer_id(F.concat(F.lit("CNPJ: "), F.col("p_partkey").cast("string"), F.lit("/0001-10 x"))).alias("documento"), "tamanho", text.size_bytes(F.col("tamanho")).alias("bytes"),
    )


@_query(r"""
SELECT page_id, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page, CASE WHEN url LIKE '%utm_source=%' THEN regexp_extract(url, '[?&]utm_source=([^&#]*)', 1) END AS utm FROM pages WHERE url LIKE '%page=%' OR url LIKE '%utm_source=%'
""")
def url_params(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages").select("page_id", text.query_param(F.col("url"), "page").alias("page"), text.query_param(F.col("url"), "utm_source").alias("utm"))
    return pages.filter("page IS NOT NULL OR utm IS NOT NULL").withColumn("page", F.coalesce("page", F.lit("")))


@_query(r"""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, 'https://example.org' || regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS moved FROM pages
""")
def url_host(spark, sf_dir):
    path = F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    return _t(spark, sf_dir, "pages").select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), text.absolute_url("https://example.org/a/b", path).alias("moved"))


@_query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS titulo, CAST(len(regexp_extract_all(html, '<a href=\"')) AS BIGINT) AS links FROM pages")
def page_title(spark, sf_dir):
    """Title and number of links, by the document tree."""
    from pyspark.sql import types as T

    from lumbre.operators.parse import parsed

    kind = T.StructType([T.StructField("titulo", T.StringType()), T.StructField("links", T.LongType())])
    return parsed(_t(spark, sf_dir, "pages").select("page_id", "html"), _title_and_links, ["html"], kind, "p").select("page_id", F.col("p.titulo").alias("titulo"), F.col("p.links").alias("links"))


def _title_and_links(html: str) -> dict:
    """The title as printed, character references as they stand."""
    import re

    from lumbre.operators.dom import parse

    root = parse(html)
    found = re.search(r"<title>([^<]*)</title>", html)
    return {"titulo": found[1] if found else "", "links": len(root.all("a", test=lambda n: "href" in n.attrs))}


@_query(r"SELECT page_id, unnest(list_distinct(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1))) AS href FROM pages")
def page_links(spark, sf_dir):
    links = F.array_distinct(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1)))
    return _t(spark, sf_dir, "pages").select("page_id", F.explode(links).alias("href"))


@_query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS reordenada, CAST(o_orderdate AS DATE) AS lida,
       'sem-data' AS ausente, true AS impossivel FROM orders
""")
def date_reformat(spark, sf_dir):
    printed = dates.format_date(F.col("o_orderdate"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", dates.reorder_date(printed).alias("reordenada"), dates.parse_date(printed).alias("lida"), dates.reorder_date(F.col("o_orderpriority")).alias("ausente"), dates.parse_date(F.concat(F.lit("31/02/"), F.date_format("o_orderdate", "yyyy"))).isNull().alias("impossivel"))


@_query("""
SELECT event_id, strftime(ts, '%d/%m/%Y %H:%M:%S') AS data, event_type AS descricao FROM events
""")
def movement_stamp(spark, sf_dir):
    """Leading time stamps split from their text."""
    raw = F.concat(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"), F.lit(" - "), F.col("event_type"))
    data, rest = text.leading_timestamp(raw)
    return _t(spark, sf_dir, "events").select("event_id", data.alias("data"), rest.alias("descricao"))


@_query("SELECT event_id, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value, CAST(len(json_keys(props)) AS BIGINT) AS n_keys FROM events")
def props_json(spark, sf_dir):
    fields = F.from_json("props", "map<string,string>")
    first = F.element_at(fields, F.get(F.json_object_keys("props"), F.lit(0)))
    return _t(spark, sf_dir, "events").select("event_id", first.alias("first_value"), F.size(F.json_object_keys("props")).cast("long").alias("n_keys"))


@_query("""
SELECT event_id, CAST(least(2000 * pow(2, event_id % 9), 120000) AS BIGINT) AS janela,
       greatest(CAST(floor(value / 1000.0 * least(2000 * pow(2, event_id % 9), 120000)) AS BIGINT), CASE WHEN event_id % 4 = 0 THEN 5000 ELSE 0 END) AS espera,
       event_id % 11 IN (0, 3) AS repetir
FROM events
""")
def backoff_windows(spark, sf_dir):
    attempt = (F.col("event_id") % 9 + 1).cast("int")
    asked = policy.retry_after_ms(F.when(F.col("event_id") % 4 == 0, F.lit("5")), F.lit("2024-01-01").cast("timestamp"))
    status = F.when(F.col("event_id") % 11 == 0, 429).when(F.col("event_id") % 11 == 3, 503).otherwise(404)
    return _t(spark, sf_dir, "events").select("event_id", policy.backoff_window(attempt).alias("janela"), policy.backoff_wait(attempt, asked, F.col("value") / F.lit(1000.0)).alias("espera"), policy.retryable(status, F.lit(None).cast("string")).alias("repetir"))


@_query("""
SELECT l_orderkey, l_linenumber, l_partkey, 'case-' || l_orderkey || '/' || lpad(CAST(l_linenumber + 1 AS VARCHAR), 4, '0') || '_' || strftime(l_shipdate, '%Y-%m-%d') || '_'
       || CASE WHEN l_returnflag = 'R' THEN 'decisao' ELSE lower(l_linestatus) END || '_' || l_partkey || '.pdf' AS caminho FROM lineitem
""")
def pdf_paths(spark, sf_dir):
    name = F.when(F.col("l_returnflag") == "R", F.lit("Decis" + chr(0xE3) + "o"))
    path = sinks.document_path(F.concat(F.lit("Case "), F.col("l_orderkey").cast("string")), F.col("l_linenumber"), dates.format_date(F.col("l_shipdate")), name, F.col("l_linestatus"), F.lit("x"), F.col("l_partkey").cast("string"))
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", path.alias("caminho"))


def queries() -> dict:
    from lumbre import page_queries

    return {**_Q, **page_queries.queries()}


def oracle_sql() -> dict[str, str]:
    from lumbre import page_queries

    return {**_SQL, **page_queries.oracle_sql()}
