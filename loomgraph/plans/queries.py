"""The registered queries of the graph engine, and the same in DuckDB's SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph import operators as ops
from loomgraph.functions.dialect import graph_sql
from loomgraph.functions.scalar import banner, path_udf
from loomgraph.metadata import DEGREE_ID, DST_INDEX, SRC_INDEX, VERTEX_INDEX
from loomgraph.plans import graphs as g
from loomgraph.plans.lineage import shared_dir
from loomgraph.sources import layout
from loomgraph.streaming.degrees import running_degrees, stream_edges

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Vertices asked for: they exist at every scale.
CUSTOMER, USER, ORDER = 42, 7, 99
SOURCES = (42, 7, 0)

_E1 = f"e1 AS (SELECT * FROM (SELECT o_custkey AS s, lead(o_custkey) OVER (ORDER BY o_orderdate, o_orderkey) AS d FROM orders) WHERE s IS NOT NULL AND d IS NOT NULL)"
_E2 = "e2 AS (SELECT o_custkey AS s, o_orderkey AS d, o_totalprice AS price, o_orderdate::DATE AS ordered_on FROM orders)"
_E3 = "e3 AS (SELECT l_suppkey AS s, l_partkey AS d, l_quantity AS quantity, l_extendedprice AS price FROM lineitem)"
_E4 = "e4 AS (SELECT * FROM (SELECT user_id AS s, lead(user_id) OVER (ORDER BY ts, event_id) AS d FROM events) WHERE s IS NOT NULL AND d IS NOT NULL)"
_SD = f's AS "{SRC_INDEX}", d AS "{DST_INDEX}"'
_VERTICES = f'SELECT c_custkey AS "{VERTEX_INDEX}", c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer'


def query(sql: str | None):
    """Register a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# scans of stored chunks


@query(_VERTICES)
def read_vertices(spark, sf_dir):
    return g.stored(spark, sf_dir).vertices("Customer")


@query(f"WITH {_E1} SELECT {_SD} FROM e1")
def read_edges(spark, sf_dir):
    return g.stored(spark, sf_dir).edges(*g.NEXT)


@query(f"WITH {_E2} SELECT {_SD}, price, ordered_on::VARCHAR AS ordered_on FROM e2")
def read_edges_with_properties(spark, sf_dir):
    return g.stored(spark, sf_dir).edges(*g.PLACES).withColumn("ordered_on", F.col("ordered_on").cast("string"))


@query(f"WITH {_E2} SELECT {_SD}, price FROM e2 WHERE price > 100000")
def edge_property_filter(spark, sf_dir):
    return g.stored(spark, sf_dir).edges(*g.PLACES, columns=["price"]).where("price > 100000")


@query("SELECT count(*) AS vertex_count FROM customer")
def vertex_count(spark, sf_dir):
    return g.stored(spark, sf_dir).vertices("Customer", columns=["name"]).agg(F.count("*").alias("vertex_count"))


@query(f"WITH {_E1} SELECT count(*) AS edge_count FROM e1")
def edge_count(spark, sf_dir):
    return g.stored(spark, sf_dir).edges(*g.NEXT).agg(F.count("*").alias("edge_count"))


@query(f"{_VERTICES} WHERE c_custkey = {CUSTOMER}")
def vertex_lookup(spark, sf_dir):
    return g.stored(spark, sf_dir).vertex("Customer", CUSTOMER)


@query(f"{_VERTICES} WHERE c_mktsegment = 'BUILDING'")
def vertex_property_filter(spark, sf_dir):
    return g.stored(spark, sf_dir).vertices("Customer").where("segment = 'BUILDING'")


@query(f"{_VERTICES} ORDER BY c_custkey LIMIT 3")
def first_k_vertices(spark, sf_dir):
    return g.stored(spark, sf_dir).vertices("Customer").orderBy(VERTEX_INDEX).limit(3)


@query(f'SELECT c_custkey AS "{VERTEX_INDEX}", c_acctbal AS balance FROM customer WHERE c_custkey BETWEEN 10 AND 99 AND c_acctbal > 0')
def range_filter(spark, sf_dir):
    v = g.stored(spark, sf_dir).vertices("Customer", columns=["balance"])
    return v.where(F.col(VERTEX_INDEX).between(10, 99) & (F.col("balance") > 0))


@query(f'SELECT c_custkey AS "{VERTEX_INDEX}", c_mktsegment AS segment FROM customer')
def projection(spark, sf_dir):
    return g.stored(spark, sf_dir).vertices("Customer", columns=["segment"])


# hops


@query(f"WITH {_E1} SELECT {_SD} FROM e1 WHERE s = {CUSTOMER}")
def one_hop_out(spark, sf_dir):
    return g.stored(spark, sf_dir).neighbors(g.NEXT, CUSTOMER)


@query(f"WITH {_E1} SELECT {_SD} FROM e1 WHERE d = {CUSTOMER}")
def one_hop_in(spark, sf_dir):
    return g.stored(spark, sf_dir).neighbors(g.NEXT, CUSTOMER, "in")


@query(f"WITH {_E2} SELECT {_SD}, price FROM e2 WHERE d = {ORDER}")
def one_hop_in_across_types(spark, sf_dir):
    return g.stored(spark, sf_dir).neighbors(g.PLACES, ORDER, "in", columns=["price"])


def _two_hop(e: str, v: int) -> str:
    return f"SELECT {_SD} FROM {e} WHERE s = {v} UNION ALL SELECT b.s, b.d FROM {e} a JOIN {e} b ON a.d = b.s WHERE a.s = {v}"


@query(f"WITH {_E1} {_two_hop('e1', CUSTOMER)}")
def two_hop(spark, sf_dir):
    return ops.two_hop(g.next_customer(spark, sf_dir), CUSTOMER)


@query(f"WITH {_E4} {_two_hop('e4', USER)}")
def two_hop_dense(spark, sf_dir):
    return ops.two_hop(g.next_user(spark, sf_dir), USER)


@query(f"WITH {_E4} SELECT a.s AS src, a.d AS mid, b.d AS dst FROM e4 a JOIN e4 b ON a.d = b.s WHERE a.s = {USER}")
def two_hop_paths(spark, sf_dir):
    return ops.two_hop_paths(g.next_user(spark, sf_dir), USER)


_ONE_MORE = f"SELECT {_SD} FROM e4 WHERE s = {USER} UNION ALL SELECT s, d FROM e4 WHERE s IN (SELECT d FROM e4 WHERE s = {USER}) AND d IN (SELECT d FROM e4 WHERE s = {USER})"


@query(f"WITH {_E4} {_ONE_MORE}")
def one_more_hop(spark, sf_dir):
    return ops.one_more_hop(g.next_user(spark, sf_dir), USER)


# degrees


def _degree(e: str, ids: str, key: str = "s") -> str:
    return f'SELECT count({key}) AS degree, id AS "{DEGREE_ID}" FROM (SELECT {ids}) LEFT JOIN {e} ON {key} = id GROUP BY id'


@query(f"WITH {_E1} {_degree('e1', 'c_custkey AS id FROM customer')}")
def degree(spark, sf_dir):
    """By one count of the edges."""
    return ops.degrees(g.next_customer(spark, sf_dir), g.customers(spark, sf_dir))


@query(f"WITH {_E1} {_degree('e1', 'c_custkey AS id FROM customer')}")
def degree_by_offsets(spark, sf_dir):
    """By the stored offsets alone."""
    return g.stored(spark, sf_dir).degrees(g.NEXT)


@query(f"WITH {_E3} {_degree('e3', 'p_partkey AS id FROM part', 'd')}")
def in_degree(spark, sf_dir):
    parts = g.table(spark, sf_dir, "part").select("p_partkey")
    return ops.degrees(g.supplies(spark, sf_dir), parts, by="dst")


@query(f"WITH {_E1} SELECT * FROM ({_degree('e1', 'c_custkey AS id FROM customer')}) WHERE \"{DEGREE_ID}\" = {CUSTOMER}")
def degree_by_id(spark, sf_dir):
    return g.stored(spark, sf_dir).degrees(g.NEXT).where(F.col(DEGREE_ID) == CUSTOMER)


@query(f"WITH {_E1} SELECT * FROM ({_degree('e1', 'c_custkey AS id FROM customer')}) ORDER BY degree DESC, \"{DEGREE_ID}\" LIMIT 1")
def max_degree(spark, sf_dir):
    return ops.max_degree(g.stored(spark, sf_dir).degrees(g.NEXT))


@query(f"WITH {_E1} SELECT degree, count(*) AS vertices FROM ({_degree('e1', 'c_custkey AS id FROM customer')}) GROUP BY degree")
def degree_distribution(spark, sf_dir):
    return ops.degree_distribution(g.stored(spark, sf_dir).degrees(g.NEXT))


# paths


def _lengths(edges: str, targets: str, sources: tuple[int, ...] = SOURCES, depth: int = 16) -> str:
    start = ", ".join(f"({s}, {s}, 0)" for s in sources)
    return f"""WITH RECURSIVE {edges}, r(src, v, n) AS (SELECT * FROM (VALUES {start}) t(src, v, n) UNION SELECT r.src, e.d, r.n + 1 FROM r JOIN e ON e.s = r.v WHERE r.n < {depth}),
    first AS (SELECT src, v, min(n) AS n FROM r GROUP BY ALL), sources(src) AS (VALUES {', '.join(f'({s})' for s in sources)}), targets AS ({targets}),
    lengths AS (SELECT sources.src::BIGINT AS src, targets.dst::BIGINT AS dst, coalesce(first.n, -1)::BIGINT AS bfs_length FROM sources CROSS JOIN targets LEFT JOIN first ON first.src = sources.src AND first.v = targets.dst)"""


_ALL = "SELECT c_custkey AS dst FROM customer"


def _pairs(targets: DataFrame, sources: tuple[int, ...] = SOURCES) -> DataFrame:
    """Every target with each of a few sources, which are part of the query."""
    return targets.select(F.explode(F.array(*[F.lit(s).cast("long") for s in sources])).alias("src"), F.col(VERTEX_INDEX).cast("long").alias("dst"))


@query(f"{_lengths(_E1 + ', e AS (SELECT * FROM e1)', _ALL)} SELECT src, dst, bfs_length FROM lengths")
def bfs_length(spark, sf_dir):
    return ops.bfs_length(g.next_customer(spark, sf_dir), _pairs(g.customers(spark, sf_dir)))


@query(f"{_lengths(_E1 + ', e AS (SELECT * FROM e1)', _ALL, (42,))} SELECT src, dst, bfs_length FROM lengths")
def bfs_length_by_levels(spark, sf_dir):
    """The traversal for graphs that are too large to broadcast."""
    return ops.bfs_length(g.next_customer(spark, sf_dir), _pairs(g.customers(spark, sf_dir), (42,)), broadcast_edges=0)


@query(f"{_lengths(_E1 + ', e AS (SELECT * FROM e1)', _ALL)} SELECT src, dst, bfs_length <> -1 AS bfs_exist FROM lengths")
def bfs_exist(spark, sf_dir):
    return ops.bfs_exist(g.next_customer(spark, sf_dir), _pairs(g.customers(spark, sf_dir)))


_WITHIN = ", e AS (SELECT e1.s, e1.d FROM e1 JOIN customer a ON a.c_custkey = e1.s JOIN customer b ON b.c_custkey = e1.d WHERE a.c_nationkey = b.c_nationkey)"


@query(f"{_lengths(_E1 + _WITHIN, _ALL, depth=99)} SELECT src, dst, bfs_length FROM lengths")
def bfs_unreachable(spark, sf_dir):
    """By edges within a nation, which leave most customers apart."""
    v = g.customers(spark, sf_dir)
    nation = lambda c: v.select(F.col(VERTEX_INDEX).alias(c), F.col("nation").alias(f"_{c}"))
    e = g.next_customer(spark, sf_dir).join(nation(SRC_INDEX), SRC_INDEX).join(nation(DST_INDEX), DST_INDEX).where(F.col(f"_{SRC_INDEX}") == F.col(f"_{DST_INDEX}"))
    return ops.bfs_length(e, _pairs(v))


@query(f"{_lengths(_E1 + ', e AS (SELECT * FROM e1)', _ALL)} SELECT src, dst, bfs_length FROM lengths")
def bfs_scalar(spark, sf_dir):
    """As a scalar function on broadcast edges."""
    length = path_udf(g.next_customer(spark, sf_dir))
    return _pairs(g.customers(spark, sf_dir)).select("src", "dst", length("src", "dst").alias("bfs_length"))


# catalog and SQL


@query("SELECT c_custkey AS id, 'Loomgraph ' || c_name || ' 🐥' AS banner FROM customer")
def banner_of_customers(spark, sf_dir):
    return g.customers(spark, sf_dir).select(F.col(VERTEX_INDEX).alias("id"), banner("name").alias("banner"))


@query("SELECT unnest(['Customer.vertex', 'Order.vertex', 'Customer_next_Customer.edge', 'Customer_places_Order.edge']) AS name")
def attach_tables(spark, sf_dir):
    names = g.stored(spark, sf_dir).attach(paths=False)
    return spark.createDataFrame([(n,) for n in names], "name string")


@query(f"WITH {_E2} SELECT c_nationkey AS nation, count(*) AS n, max(price) AS most FROM e2 JOIN customer ON s = c_custkey GROUP BY c_nationkey")
def attached_sql(spark, sf_dir):
    g.stored(spark, sf_dir).attach(paths=False)
    return spark.sql(f"SELECT nation, count(*) AS n, max(price) AS most FROM `Customer_places_Order.edge` JOIN `Customer.vertex` ON {SRC_INDEX} = {VERTEX_INDEX} GROUP BY nation")


@query(f"WITH {_E1} {_two_hop('e1', CUSTOMER)}")
def two_hop_function(spark, sf_dir):
    g.stored(spark, sf_dir).attach(paths=False)
    return spark.sql(f"SELECT * FROM two_hop(vid => {CUSTOMER})")


@query(f"WITH {_E1} SELECT {_SD} FROM e1 WHERE s = {CUSTOMER} UNION ALL SELECT s, d FROM e1 WHERE s IN (SELECT d FROM e1 WHERE s = {CUSTOMER}) AND d IN (SELECT d FROM e1 WHERE s = {CUSTOMER})")
def one_more_hop_function(spark, sf_dir):
    g.stored(spark, sf_dir).attach(paths=False)
    return spark.sql(f"SELECT * FROM one_more_hop(vid => {CUSTOMER})")


@query(f"WITH {_E1} SELECT * FROM ({_degree('e1', 'c_custkey AS id FROM customer')}) WHERE degree > 5")
def edges_vertex_function(spark, sf_dir):
    g.stored(spark, sf_dir).attach(paths=False)
    return spark.sql("SELECT * FROM edges_vertex() WHERE degree > 5")


@query(f"{_lengths(_E1 + ', e AS (SELECT * FROM e1)', 'SELECT c_custkey AS dst FROM customer', (42,))} SELECT dst AS id, bfs_length, bfs_length <> -1 AS bfs_exist FROM lengths")
def bfs_functions(spark, sf_dir):
    g.stored(spark, sf_dir).attach(paths=True)
    return spark.sql(f"SELECT {VERTEX_INDEX} AS id, bfs_length(42, {VERTEX_INDEX}) AS bfs_length, bfs_exist(42, {VERTEX_INDEX}) AS bfs_exist FROM `Customer.vertex`")


@query("SELECT unnest(['Customer.vertex', 'Order.vertex', 'Customer_next_Customer.edge', 'Customer_places_Order.edge']) AS name")
def show_tables(spark, sf_dir):
    """Of the graph attached under a name of its own."""
    g.stored(spark, sf_dir).attach(paths=False, alias="stored")
    return graph_sql(spark, "SELECT name FROM (SHOW ALL TABLES) WHERE database = 'stored'")


@query(f"WITH {_E1} SELECT d AS dst, count(*) AS n FROM e1 GROUP BY d")
def named_graph_sql(spark, sf_dir):
    """A table of a graph that was attached under a name."""
    g.stored(spark, sf_dir).attach(paths=False, alias="named")
    return graph_sql(spark, f"SELECT {DST_INDEX} AS dst, count(*) AS n FROM named.'{'_'.join(g.NEXT)}.edge' GROUP BY {DST_INDEX}")


@query(f'SELECT c_custkey AS "{VERTEX_INDEX}" FROM customer WHERE c_custkey < 0')
def out_of_range_filter(spark, sf_dir):
    """A predicate on ids that don't exist gives no rows; as an argument such an id is an error."""
    return g.stored(spark, sf_dir).vertices("Customer", columns=[]).where(f"{VERTEX_INDEX} = -5")


@query(f"WITH {_E1} SELECT count(*) AS degree, s AS \"{DEGREE_ID}\" FROM e1 GROUP BY s")
def streamed_degrees(spark, sf_dir):
    """Degrees kept by a stream over the stored chunks of edges."""
    stored = g.stored(spark, sf_dir)
    e = stored.info.edge(*g.NEXT)
    where = f"{shared_dir(spark)}/loomgraph/stream-{uuid.uuid4().hex}"
    chunks = stream_edges(spark, layout.adjacency(stored.info.directory, e, e.order("src")))
    write = running_degrees(chunks).writeStream.outputMode("complete").option("checkpointLocation", f"{where}/state").trigger(availableNow=True)
    write.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{where}/degrees")).start().awaitTermination()
    return spark.read.parquet(f"{where}/degrees")


# the host's own relational operators, over attached tables


def attached(sql: str):
    """A query over the attached tables customers, next and places."""

    def run(spark, sf_dir):
        g.stored(spark, sf_dir).attach(paths=False)
        views = {"customers": "Customer.vertex", "next": f"{'_'.join(g.NEXT)}.edge", "places": f"{'_'.join(g.PLACES)}.edge"}
        return spark.sql(sql.format(**{k: f"`{v}`" for k, v in views.items()}))

    return run


_PLACED = "SELECT o_custkey AS s, o_orderkey AS d, o_totalprice AS price, o_orderdate::DATE AS ordered_on FROM orders"
_V, _S, _D = VERTEX_INDEX, SRC_INDEX, DST_INDEX
HOST: dict[str, tuple[str, str]] = {
    "sort_merge_join": (
        f"SELECT /*+ MERGE(v) */ segment, count(*) AS n, max(price) AS most FROM {{places}} e JOIN {{customers}} v ON e.{_S} = v.{_V} GROUP BY segment",
        "SELECT c_mktsegment AS segment, count(*) AS n, max(o_totalprice) AS most FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
    ),
    "theta_join": (  # one row a nation on the other side
        f"SELECT v.{_V} AS id, count(*) AS n FROM {{customers}} v JOIN (SELECT nation, avg(balance) AS mean FROM {{customers}} GROUP BY nation) t ON v.balance > t.mean AND v.nation <> t.nation GROUP BY v.{_V}",
        "SELECT c_custkey AS id, count(*) AS n FROM customer v JOIN (SELECT c_nationkey AS nation, avg(c_acctbal) AS mean FROM customer GROUP BY ALL) t ON c_acctbal > mean AND c_nationkey <> nation GROUP BY ALL",
    ),
    "range_join": (
        "SELECT band, count(*) AS n FROM {places} JOIN (VALUES (1, 0D, 50000D), (2, 50000D, 150000D), (3, 150000D, 300000D), (4, 300000D, 1e9D)) AS b(band, lo, hi) ON price >= lo AND price < hi GROUP BY band",
        f"SELECT band, count(*) AS n FROM ({_PLACED}) JOIN (VALUES (1, 0, 50000), (2, 50000, 150000), (3, 150000, 300000), (4, 300000, 1e9)) AS b(band, lo, hi) ON price >= lo AND price < hi GROUP BY band",
    ),
    "as_of_join": (
        f"SELECT {_S} AS id, cast(day AS string) AS day, cast(max(ordered_on) AS string) AS latest FROM {{places}} JOIN (VALUES (date'1995-01-01'), (date'1997-06-30'), (date'2024-06-30')) AS t(day) ON ordered_on <= day GROUP BY {_S}, day",
        f"SELECT s AS id, day::VARCHAR AS day, max(ordered_on)::VARCHAR AS latest FROM ({_PLACED}) JOIN (VALUES (DATE '1995-01-01'), (DATE '1997-06-30'), (DATE '2024-06-30')) AS t(day) ON ordered_on <= day GROUP BY s, day",
    ),
    "grouping_sets": (
        "SELECT nation, segment, count(*) AS n FROM {customers} GROUP BY GROUPING SETS ((nation, segment), (segment), ())",
        "SELECT c_nationkey AS nation, c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY GROUPING SETS ((c_nationkey, c_mktsegment), (c_mktsegment), ())",
    ),
    "cube": ("SELECT nation, segment, max(balance) AS most FROM {customers} GROUP BY CUBE (nation, segment)", "SELECT c_nationkey AS nation, c_mktsegment AS segment, max(c_acctbal) AS most FROM customer GROUP BY CUBE (c_nationkey, c_mktsegment)"),
    "rollup": ("SELECT nation, segment, min(balance) AS least FROM {customers} GROUP BY ROLLUP (nation, segment)", "SELECT c_nationkey AS nation, c_mktsegment AS segment, min(c_acctbal) AS least FROM customer GROUP BY ROLLUP (c_nationkey, c_mktsegment)"),
    "approximate_distinct": (  # engines' sketches differ: the estimate is compared with the truth
        f"SELECT count(DISTINCT {_D}) AS n, abs(approx_count_distinct({_D}, 0.02) - count(DISTINCT {_D})) <= 0.1 * count(DISTINCT {_D}) AS near FROM {{next}}",
        f"WITH {_E1} SELECT count(DISTINCT d) AS n, true AS near FROM e1",
    ),
    "subqueries": (
        f"WITH d AS (SELECT {_S} AS id, count(*) AS n FROM {{next}} GROUP BY {_S}) SELECT id, n FROM d WHERE n > (SELECT avg(n) FROM d) AND id IN (SELECT {_V} FROM {{customers}} WHERE balance > 0) AND EXISTS (SELECT 1 FROM {{places}} p WHERE p.{_S} = d.id AND price > 100000)",
        f"WITH {_E1}, g AS (SELECT s AS id, count(*) AS n FROM e1 GROUP BY s) SELECT id, n FROM g WHERE n > (SELECT avg(n) FROM g) AND id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = g.id AND o_totalprice > 100000)",
    ),
    "pivot": (
        "SELECT nation, coalesce(building, 0) AS building, coalesce(other, 0) AS other FROM (SELECT nation, CASE WHEN segment = 'BUILDING' THEN 'b' ELSE 'o' END AS kind FROM {customers}) PIVOT (count(*) FOR kind IN ('b' AS building, 'o' AS other))",
        "SELECT c_nationkey AS nation, count(*) FILTER (c_mktsegment = 'BUILDING') AS building, count(*) FILTER (c_mktsegment <> 'BUILDING') AS other FROM customer GROUP BY ALL",
    ),
    "unnest": (
        f"SELECT {_V} AS id, part FROM {{customers}} LATERAL VIEW explode(split(name, '#')) AS part",
        "SELECT c_custkey AS id, unnest(string_split(c_name, '#')) AS part FROM customer",
    ),
    "sample": (f"SELECT count(*) AS n, sum({_S}) AS total FROM {{next}} TABLESAMPLE (100 PERCENT)", f"WITH {_E1} SELECT count(*) AS n, sum(s)::BIGINT AS total FROM e1"),
}
for _name, (_spark, _sql) in HOST.items():
    QUERIES[_name], ORACLES[_name] = attached(_spark), _sql
