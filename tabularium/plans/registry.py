"""Queries by name, one or more for each operator, and the SQL that gives the same rows.

Keys begin with the operator they exercise.  Product queries run the published
products over the raw tables of ``testbed``; the others run one operator over
the star-schema tables.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession, Window

from ..contracts import CONTRACTS, PRODUCT_SCHEMAS
from ..functions import taxid, text, types
from ..operators import documents, products, quality, search
from .testbed import TABLES, ctes, raw_tables, read

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is there already")
        QUERIES[key] = f
        if sql is not None:
            ORACLE_SQL[key] = sql
        return f

    return add


class Bed:
    """Tables of one call, read when first named."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name)

    @property
    def raw(self) -> dict[str, DataFrame]:
        return raw_tables(self.spark, self.sf_dir)


def over(sql: str | None = None):
    """A query written as a function of a Bed."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Bed(spark, sf_dir))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        query(sql, f.__name__)(run)
        return f

    return add


# ---- sources ----


@over(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def s6_scan_count(b: Bed) -> DataFrame:
    out = [getattr(b, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t in TABLES]
    df = out[0]
    for more in out[1:]:
        df = df.unionByName(more)
    return df


@over("SELECT 'orders' AS source, count(*) AS n, min(o_orderkey) AS lo FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'customer', count(*), min(c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING'")
def s15_filtered_count(b: Bed) -> DataFrame:
    o = b.orders.filter("o_orderstatus = 'F'").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("lo")).select(F.lit("orders").alias("source"), "n", "lo")
    c = b.customer.filter("c_mktsegment = 'BUILDING'").agg(F.count("*").alias("n"), F.min("c_custkey").alias("lo")).select(F.lit("customer").alias("source"), "n", "lo")
    return o.unionByName(c)


@over("SELECT * FROM (VALUES (1, 'n_nationkey'), (2, 'n_name'), (3, 'n_regionkey')) AS t(position, name)")
def s16_describe(b: Bed) -> DataFrame:
    from ..sources.snapshot import describe

    return describe(b.nation).select("position", "name")


@over("SELECT i AS id, lpad(cast(i AS varchar), 8, '0') AS root, CASE WHEN i % 3 = 0 THEN 'branch' ELSE 'seat' END AS kind FROM range(1, 1001) AS r(i)")
def s17_generated_rows(b: Bed) -> DataFrame:
    return b.spark.range(1, 1001).select("id", F.lpad(F.col("id").cast("string"), 8, "0").alias("root"), F.when(F.col("id") % 3 == 0, "branch").otherwise("seat").alias("kind"))


@over("SELECT event_type || '.part' AS source_file, count(*) AS n, sum(event_id)::BIGINT AS total FROM events GROUP BY event_type")
def s18_part_tagged_union(b: Bed) -> DataFrame:
    parts = [b.events.filter(F.col("event_type") == t).withColumn("source_file", F.lit(f"{t}.part")) for t in ("signup", "view", "purchase", "error", "click")]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return df.groupBy("source_file").agg(F.count("*").alias("n"), F.sum("event_id").alias("total"))


# ---- projections, filters ----


@over("SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, l_returnflag || '-' || l_linestatus AS flag, l_quantity >= 25 AS large FROM lineitem")
def p1_projection(b: Bed) -> DataFrame:
    return b.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), F.concat("l_returnflag", F.lit("-"), "l_linestatus").alias("flag"), (F.col("l_quantity") >= 25).alias("large"))


@over("SELECT o_orderkey AS key, o_orderkey % 7 AS bucket, 'orders' AS _source_file FROM orders")
def p4_lineage_columns(b: Bed) -> DataFrame:
    return b.orders.select(F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 7).alias("bucket"), F.lit("orders").alias("_source_file"))


_UF = "SELECT count(*) AS rows_all, count(*) FILTER (uf IS NOT NULL AND uf <> '') AS filled, count(*) FILTER (uf IS NULL OR trim(uf) = '') AS blanks FROM estabelecimento"


@over(f"WITH {ctes('estabelecimento')} z AS (SELECT 1) {_UF}")
def p5_p6_blank_predicates(b: Bed) -> DataFrame:
    return b.raw["estabelecimento"].agg(F.count("*").alias("rows_all"), F.count_if(text.filled(F.col("uf"))).alias("filled"), F.count_if(text.blank(F.col("uf"))).alias("blanks"))


@over("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey <> 4")
def p7_bound_parameters(b: Bed) -> DataFrame:
    return b.spark.sql("SELECT c_custkey, c_name FROM {customer} WHERE c_mktsegment = :segment AND c_nationkey <> :nation", args={"segment": "BUILDING", "nation": 4}, customer=b.customer)


@over("SELECT c_custkey, c_name FROM customer WHERE c_name >= 'Customer#000000020' AND c_name < 'Customer#000000045'")
def p8_half_open_range(b: Bed) -> DataFrame:
    return b.customer.filter((F.col("c_name") >= "Customer#000000020") & (F.col("c_name") < "Customer#000000045")).select("c_custkey", "c_name")


@over("SELECT p_partkey, p_name, left(p_name, 1) AS initial FROM part WHERE left(p_name, 1) = 's'")
def p9_prefix(b: Bed) -> DataFrame:
    return b.part.filter(F.substring("p_name", 1, 1) == "s").select("p_partkey", "p_name", F.left("p_name", F.lit(1)).alias("initial"))


@over("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RING%' ORDER BY p_name, p_partkey LIMIT 20")
def p10_ilike_topk(b: Bed) -> DataFrame:
    return b.part.filter(F.col("p_name").ilike("%RING%")).orderBy("p_name", "p_partkey").limit(20).select("p_partkey", "p_name")


@over("SELECT doc_id FROM documents WHERE contains(upper(strip_accents(text)), 'ENTION')")
def p11_contains_normalised(b: Bed) -> DataFrame:
    return b.documents.filter(text.upper_plain(F.col("text")).contains("ENTION")).select("doc_id")


@over("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)")
def p12_in_subquery(b: Bed) -> DataFrame:
    rich = b.customer.filter("c_acctbal > 9000").select(F.col("c_custkey").alias("o_custkey"))
    return b.orders.join(rich, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@over("SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') IS DISTINCT FROM nullif(left(o_orderpriority, 1), '1')")
def p13_null_safe_difference(b: Bed) -> DataFrame:
    left, right = F.nullif(F.col("o_orderstatus"), F.lit("P")), F.nullif(F.left("o_orderpriority", F.lit(1)), F.lit("1"))
    return b.orders.filter(~left.eqNullSafe(right)).select("o_orderkey")


@over("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE '' END AS label FROM orders")
def p14_coded_label(b: Bed) -> DataFrame:
    return b.orders.select("o_orderkey", types.coded(F.col("o_orderstatus"), {"F": "final", "O": "open"}).alias("label"))


@over(f"WITH {ctes('simples')} z AS (SELECT 1) SELECT cnpj_basico, CASE opcao_simples WHEN 'S' THEN true WHEN 'N' THEN false END AS opcao_simples, CASE opcao_mei WHEN 'S' THEN true WHEN 'N' THEN false END AS opcao_mei FROM simples")
def p15_yes_no(b: Bed) -> DataFrame:
    return b.raw["simples"].select("cnpj_basico", *[types.yes_no(F.col(c)).alias(c) for c in ("opcao_simples", "opcao_mei")])


@over("SELECT event_id, CASE WHEN event_type = 'purchase' THEN value END AS paid, CASE WHEN event_type = 'view' THEN user_id END AS viewer FROM events")
def p16_conditional_split(b: Bed) -> DataFrame:
    return b.events.select("event_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("paid"), F.when(F.col("event_type") == "view", F.col("user_id")).alias("viewer"))


@over("SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS segment FROM customer")
def p17_coalesce(b: Bed) -> DataFrame:
    return b.customer.select("c_custkey", F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("")).alias("segment"))


@over("SELECT * REPLACE (upper(n_name) || '!' AS n_name) FROM nation")
def p18_replace_column(b: Bed) -> DataFrame:
    return b.nation.withColumn("n_name", F.concat(F.upper("n_name"), F.lit("!")))


_TYPED = """
SELECT cnpj_basico, razao_social, natureza_juridica, qualificacao_responsavel, try_cast(replace(capital_social, ',', '.') AS decimal(18,2))::varchar AS capital_social, porte_empresa, ente_federativo_responsavel,
  'part-' || right(cnpj_basico, 1) AS _source_file, '2026-04' AS _source_snapshot FROM empresa
"""


@over(f"WITH {ctes('empresa')} z AS (SELECT 1) {_TYPED}")
def p3_c9_typed_projection(b: Bed) -> DataFrame:
    raw = quality.collapse(b.raw["empresa"].unionByName(b.raw["empresa"]), ("cnpj_basico",))
    out = quality.typed(raw, CONTRACTS["empresa"], source_file=F.concat(F.lit("part-"), F.right("cnpj_basico", F.lit(1))), snapshot="2026-04")
    return out.withColumn("capital_social", F.col("capital_social").cast("string"))


# ---- joins ----


@over("SELECT o.o_orderkey, c.c_name, s.s_name FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 3000) c ON c.c_custkey = o.o_custkey LEFT JOIN supplier s ON s.s_suppkey = o.o_custkey")
def j1_left_joins(b: Bed) -> DataFrame:
    c, s = b.customer.filter("c_acctbal > 3000"), b.supplier
    return b.orders.join(c, F.col("c_custkey") == F.col("o_custkey"), "left").join(s, F.col("s_suppkey") == F.col("o_custkey"), "left").select("o_orderkey", "c_name", "s_name")


@over("SELECT c_custkey, coalesce(n_name, '') AS nation_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON n.n_nationkey = c_nationkey")
def j2_dimension_join(b: Bed) -> DataFrame:
    n = b.nation.filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("codigo"), F.col("n_name").alias("descricao"))
    return products.described(b.customer, n, "c_nationkey", "nation_name").select("c_custkey", "nation_name")


@over("SELECT DISTINCT o.o_orderkey, cn.n_name AS customer_nation, sn.n_name AS supplier_nation FROM orders o JOIN customer c ON c_custkey = o_custkey JOIN lineitem l ON l_orderkey = o_orderkey JOIN supplier s ON s_suppkey = l_suppkey JOIN nation cn ON cn.n_nationkey = c_nationkey JOIN nation sn ON sn.n_nationkey = s_nationkey")
def j3_dimension_twice(b: Bed) -> DataFrame:
    lines = b.lineitem.select("l_orderkey", "l_suppkey").distinct().join(b.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    df = b.orders.join(b.customer, F.col("c_custkey") == F.col("o_custkey")).join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    for code, name in (("c_nationkey", "customer_nation"), ("s_nationkey", "supplier_nation")):
        side = F.broadcast(b.nation.select(F.col("n_nationkey").alias(f"__{code}"), F.col("n_name").alias(name)))  # 25 nations
        df = df.join(side, F.col(code) == F.col(f"__{code}"))
    return df.select("o_orderkey", "customer_nation", "supplier_nation").distinct()


@over("SELECT c_custkey, o.n AS orders, o.last_key, l.n AS large_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS last_key FROM orders GROUP BY 1) o ON o.o_custkey = c_custkey LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 300000 GROUP BY 1) l ON l.o_custkey = c_custkey")
def j4_preaggregated_joins(b: Bed) -> DataFrame:
    # Both aggregates are one grouping on the join key, so one shuffle of the facts serves them.
    large = F.count_if(F.col("o_totalprice") > 300000)
    o = b.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.max("o_orderkey").alias("last_key"), F.nullif(large, F.lit(0)).alias("large_orders"))
    return b.customer.select("c_custkey").join(o, "c_custkey", "left")


@over("SELECT s.s_suppkey, s.s_name FROM supplier s JOIN (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING sum(l_quantity) > 1500) l ON l.l_suppkey = s.s_suppkey")
def j6_semi_as_filter(b: Bed) -> DataFrame:
    busy = b.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum("l_quantity").alias("q")).filter("q > 1500")
    return b.supplier.join(busy, "s_suppkey", "left_semi").select("s_suppkey", "s_name")


@over("SELECT o.o_orderkey, o.o_custkey, c.c_name FROM (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY o_orderkey LIMIT 30) o JOIN customer c ON c.c_custkey = o.o_custkey")
def j7_limit_then_join(b: Bed) -> DataFrame:
    first = b.orders.filter("o_orderpriority = '1-URGENT'").orderBy("o_orderkey").limit(30)
    return b.customer.join(F.broadcast(first), F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "o_custkey", "c_name")


@over("SELECT l_orderkey, l_linenumber, upper(p_name) AS part_name FROM lineitem JOIN part ON p_partkey = l_partkey WHERE contains(upper(p_name), 'WIDGET') AND l_quantity > 45")
def j8_fact_lookup_contains(b: Bed) -> DataFrame:
    p = b.part.select(F.col("p_partkey").alias("l_partkey"), text.upper_plain(F.col("p_name")).alias("part_name")).filter(F.col("part_name").contains("WIDGET"))
    return b.lineitem.filter("l_quantity > 45").join(p, "l_partkey").select("l_orderkey", "l_linenumber", "part_name")


@over("SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_totalprice > 450000)")
def j9_left_semi(b: Bed) -> DataFrame:
    big = b.orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return b.customer.select("c_custkey").join(big, "c_custkey", "left_semi")


@over("WITH m AS (SELECT map(list(n_nationkey), list(n_name)) AS m FROM nation) SELECT c_custkey, coalesce(m.m[c_nationkey], '') AS nation_name FROM customer, m")
def j10_a10_map_of_dimension(b: Bed) -> DataFrame:
    m = b.nation.agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("m"))
    return b.customer.crossJoin(F.broadcast(m)).select("c_custkey", F.coalesce(F.try_element_at("m", "c_nationkey"), F.lit("")).alias("nation_name"))  # m is one row


@over("SELECT DISTINCT b.l_orderkey AS other, a.l_partkey AS via FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey WHERE a.l_orderkey < 40 AND b.l_orderkey >= 40")
def j11_one_hop_self_join(b: Bed) -> DataFrame:
    # Only the keys of the near side are needed, so the hop is a semi-join: no pair is formed.
    mine = b.lineitem.filter("l_orderkey < 40").select("l_partkey", "l_suppkey").distinct()
    return b.lineitem.filter("l_orderkey >= 40").join(mine, ["l_partkey", "l_suppkey"], "left_semi").select(F.col("l_orderkey").alias("other"), F.col("l_partkey").alias("via")).distinct()


@over("SELECT p_partkey, CAST(NULL AS varchar) AS description, p_brand AS brand FROM part")
def j12_optional_lookup(b: Bed) -> DataFrame:
    return products.described(b.part, None, "p_type", "description").select("p_partkey", "description", F.col("p_brand").alias("brand"))


@over("SELECT p_partkey, unnest(range(1, 1 + len(string_split(p_name, ' '))))::INTEGER AS position, unnest(string_split(p_name, ' ')) AS word FROM part")
def j13_f13_f15_lateral_ordinal(b: Bed) -> DataFrame:
    return b.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("at", "word")).select("p_partkey", (F.col("at") + 1).alias("position"), "word")


@over("SELECT l_orderkey, l_linenumber, 'flag' AS kind, l_returnflag AS entry, 1 AS position FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'status', l_linestatus, 2 FROM lineitem")
def j14_u1_unpivot(b: Bed) -> DataFrame:
    entry = lambda kind, c, at: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("entry"), F.lit(at).alias("position"))
    return b.lineitem.select("l_orderkey", "l_linenumber", F.explode(F.array(entry("flag", "l_returnflag", 1), entry("status", "l_linestatus", 2))).alias("e")).select("l_orderkey", "l_linenumber", "e.*")


@over("SELECT count(*) AS differing FROM orders WHERE o_orderkey % 50 = 0")
def j15_verification_join(b: Bed) -> DataFrame:
    changed = b.orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 50 == 0, F.lit(-1.0)).otherwise(F.col("o_totalprice")))
    return quality.mismatches(b.orders, changed, ("o_orderkey",), {"o_totalprice": "o_totalprice", "o_orderstatus": "o_orderstatus"}).agg(F.count("*").alias("differing"))


@over("SELECT l.l_orderkey, l.l_linenumber, count(*) AS n, min(l_partkey) AS lo, max(l_partkey) AS hi FROM lineitem l JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) d ON d.l_orderkey = l.l_orderkey AND d.l_linenumber = l.l_linenumber GROUP BY 1, 2")
def j16_duplicates_with_detail(b: Bed) -> DataFrame:
    # Detail and count share the grouping, so no join back is needed.
    return b.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi")).filter("n > 1")


# ---- aggregates ----


@over("SELECT o_custkey, count(*)::INTEGER AS n, (count(*) FILTER (o_orderstatus = 'F'))::INTEGER AS final, count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY 1")
def a1_a2_a3_counts(b: Bed) -> DataFrame:
    return b.orders.groupBy("o_custkey").agg(F.count("*").cast("int").alias("n"), F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("final"), F.count_distinct("o_orderpriority").alias("priorities"))


@over("SELECT l_orderkey, l_linenumber, count(DISTINCT {'a': l_partkey, 'b': l_suppkey, 'c': l_returnflag}) AS variants FROM lineitem GROUP BY 1, 2")
def a4_distinct_structs(b: Bed) -> DataFrame:
    return b.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count_distinct(F.struct("l_partkey", "l_suppkey", "l_returnflag")).alias("variants"))


@over("SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS priorities FROM orders GROUP BY 1")
def a5_a8_sorted_distinct_list(b: Bed) -> DataFrame:
    return b.orders.groupBy("o_custkey").agg(F.array_join(products.sorted_distinct("o_orderpriority"), "|").alias("priorities"))


@over("SELECT o_custkey, array_to_string(list(o_orderkey ORDER BY o_orderkey)[1:3], ',') AS first_three FROM orders GROUP BY 1")
def a7_ordered_list_slice(b: Bed) -> DataFrame:
    return b.orders.groupBy("o_custkey").agg(F.array_join(F.slice(F.array_sort(F.collect_list("o_orderkey")), 1, 3).cast("array<string>"), ",").alias("first_three"))


@over("SELECT c_nationkey, min(c_mktsegment) AS any_segment, arg_min(c_name, c_custkey) AS first_name FROM customer GROUP BY 1")
def a9_representative(b: Bed) -> DataFrame:
    return b.customer.groupBy("c_nationkey").agg(F.min("c_mktsegment").alias("any_segment"), F.min_by("c_name", "c_custkey").alias("first_name"))


@over("SELECT count(*) AS groups, coalesce(sum(n - 1), 0)::BIGINT AS excess, coalesce(sum(CASE WHEN n > 2 THEN 1 ELSE 0 END), 0)::BIGINT AS triples FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def a11_a12_a13_two_level(b: Bed) -> DataFrame:
    groups = b.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")
    return groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("excess"), F.coalesce(F.sum(F.when(F.col("n") > 2, 1).otherwise(0)), F.lit(0)).cast("long").alias("triples"))


_KEY_AUDIT = """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_returnflag) AS parts FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
SELECT 0::BIGINT AS blank_l_orderkey, 0::BIGINT AS blank_l_linenumber, count(*) AS duplicate_keys, coalesce(sum(n - 1), 0)::BIGINT AS excess_rows, count(*) FILTER (parts > 1) AS cross_part_keys FROM k
"""


@over(_KEY_AUDIT)
def a14_c11_c14_key_audit(b: Bed) -> DataFrame:
    df = b.lineitem.select(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), "l_returnflag")
    return quality.key_summary(df, ("l_orderkey", "l_linenumber"), "l_returnflag")


@over("SELECT md5(string_agg(n_nationkey || ':' || n_name, ',' ORDER BY n_nationkey)) AS checksum FROM nation")
def a15_ordered_checksum(b: Bed) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct("n_nationkey", F.concat(F.col("n_nationkey").cast("string"), F.lit(":"), "n_name").alias("t"))))
    return b.nation.agg(F.md5(F.array_join(F.transform(rows, lambda x: x["t"]), ",")).alias("checksum"))  # 25 rows


@over("SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1 ORDER BY n DESC, word LIMIT 10")
def a16_unnest_topk(b: Bed) -> DataFrame:
    return b.part.select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(10)


@over("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def a17_distinct(b: Bed) -> DataFrame:
    return b.orders.select("o_custkey", "o_orderstatus").distinct()


@over("SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def a18_shared_values(b: Bed) -> DataFrame:
    return b.lineitem.groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("suppliers")).filter("suppliers > 1")


# ---- windows, order, sampling ----


@over("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def w1_w2_first_per_key(b: Bed) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return b.orders.withColumn("r", F.row_number().over(w)).filter("r = 1").select("o_custkey", "o_orderkey")


_FIRST = """
WITH t AS (SELECT CASE WHEN l_orderkey % 100 = 7 THEN NULL ELSE cast(l_orderkey AS varchar) END AS k, l_linenumber AS line, l_partkey AS part, l_returnflag AS src FROM lineitem)
SELECT k, line, part, src FROM (SELECT *, row_number() OVER (PARTITION BY k, line ORDER BY part NULLS LAST, src NULLS LAST) AS r FROM t WHERE k IS NOT NULL) WHERE r = 1
UNION ALL SELECT k, line, part, src FROM t WHERE k IS NULL
"""


@over(_FIRST)
def w3_w4_c8_collapse(b: Bed) -> DataFrame:
    key = F.when(F.col("l_orderkey") % 100 != 7, F.col("l_orderkey").cast("string"))
    t = b.lineitem.select(key.alias("k"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("src"))
    keyed = t.withColumn("line", F.col("line").cast("string"))
    return quality.collapse(keyed, ("k", "line"), ["k", "line", "part"]).withColumn("line", F.col("line").cast("int"))


@over("SELECT o_orderkey, row_number() OVER (ORDER BY nullif(o_orderstatus, 'P') NULLS LAST, round(o_totalprice / 1000), o_orderkey) AS place FROM orders WHERE o_orderkey < 200")
def o1_nulls_last_order(b: Bed) -> DataFrame:
    w = Window.orderBy(F.nullif(F.col("o_orderstatus"), F.lit("P")).asc_nulls_last(), F.round(F.col("o_totalprice") / 1000), "o_orderkey")
    return b.orders.filter("o_orderkey < 200").select("o_orderkey", F.row_number().over(w).cast("long").alias("place"))


@over("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def o2_topk(b: Bed) -> DataFrame:
    return b.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@over("SELECT c_custkey FROM customer ORDER BY sha256(cast(c_custkey AS varchar) || chr(31) || '42'), c_custkey LIMIT 50")
def o4_hash_ranked_sample(b: Bed) -> DataFrame:
    return quality.sample_keys(b.customer, ("c_custkey",), 50)


@over("SELECT c_custkey, array_to_string(list(t.k ORDER BY t.p NULLS LAST, t.k), ',') AS ordered FROM customer JOIN (SELECT o_custkey, o_orderkey AS k, nullif(o_orderpriority, '5-LOW') AS p FROM orders) t ON t.o_custkey = c_custkey GROUP BY 1")
def o7_child_order_nulls_last(b: Bed) -> DataFrame:
    o = b.orders.select(F.col("o_custkey").alias("c_custkey"), F.struct(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"), F.col("o_orderkey").alias("k")).alias("x"))
    rows = documents.ordered(F.col("all"), ("p", "k"))
    return o.groupBy("c_custkey").agg(F.collect_list("x").alias("all")).select("c_custkey", F.array_join(F.transform(rows, lambda x: x["k"].cast("string")), ",").alias("ordered"))


@over("SELECT count(*) AS keys, 0::BIGINT AS out_of_order FROM (SELECT DISTINCT c_custkey FROM customer)")
def o8_increasing_keys(b: Bed) -> DataFrame:
    """Keys that do not follow the one before them, within the range partitions that a sorted writer makes."""
    w = Window.partitionBy(F.spark_partition_id()).orderBy("c_custkey")
    keys = b.customer.repartitionByRange("c_custkey").withColumn("before", F.lag("c_custkey").over(w))
    return keys.agg(F.count("*").alias("keys"), F.count_if(F.col("c_custkey") <= F.col("before")).alias("out_of_order"))


# ---- sets ----


@over("SELECT s_name AS name, s_nationkey AS nation FROM supplier UNION ALL SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def u2_union_one_distinct(b: Bed) -> DataFrame:
    c = b.customer.select(F.col("c_mktsegment").alias("name"), F.col("c_nationkey").alias("nation")).distinct()
    return b.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")).unionByName(c)


@over("SELECT (SELECT count(*) FROM (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_quantity > 10 EXCEPT ALL SELECT l_partkey, l_suppkey FROM lineitem WHERE l_quantity <= 40)) AS only_left, (SELECT count(*) FROM (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_quantity <= 40 EXCEPT ALL SELECT l_partkey, l_suppkey FROM lineitem WHERE l_quantity > 10)) AS only_right")
def u4_except_all(b: Bed) -> DataFrame:
    x = b.lineitem.filter("l_quantity > 10").select("l_partkey", "l_suppkey")
    y = b.lineitem.filter("l_quantity <= 40").select("l_partkey", "l_suppkey")
    return quality.bag_difference(x, y)


@over("SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def u5_except(b: Bed) -> DataFrame:
    return b.orders.filter("o_orderstatus = 'F'").select("o_custkey").subtract(b.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey"))


# ---- scalar functions ----


@over("SELECT c_custkey, c_name || nullif(c_mktsegment, 'BUILDING') AS joined, substr(c_name, 10, 4) AS middle, left(c_name, 3) AS start FROM customer")
def f1_f2_concat_substring(b: Bed) -> DataFrame:
    return b.customer.select("c_custkey", F.concat("c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("joined"), F.substring("c_name", 10, 4).alias("middle"), F.left("c_name", F.lit(3)).alias("start"))


@over("SELECT doc_id, md5(upper(strip_accents(text))) AS plain, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS collapsed FROM documents")
def f3_f4_f5_normalise(b: Bed) -> DataFrame:
    t = F.col("text")
    return b.documents.select("doc_id", F.md5(text.upper_plain(t)).alias("plain"), F.md5(F.trim(text.collapse_spaces(t))).alias("collapsed"))


_STREET = """
SELECT {key}, coalesce(MAP {{'R': 'RUA ', 'AV': 'AVENIDA ', 'TV': 'TRAVESSA ', 'AL': 'ALAMEDA ', 'PCA': 'PRACA ', 'PC': 'PRACA ', 'EST': 'ESTRADA ', 'ROD': 'RODOVIA ', 'VL': 'VILA ', 'LG': 'LARGO '}}[regexp_extract(s, '^([A-Z]+)\\.?\\s+', 1)]
       || regexp_replace(s, '^[A-Z]+\\.?\\s+', ''), s) AS {name}
"""


@over(f"WITH {ctes('estabelecimento')} b AS (SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, upper(strip_accents(trim(regexp_replace(logradouro, '\\s+', ' ', 'g')))) AS s FROM estabelecimento) {_STREET.format(key='cnpj', name='street')} FROM b")
def f6_f7_c5_street(b: Bed) -> DataFrame:
    return b.raw["estabelecimento"].select(products.full_id().alias("cnpj"), text.street(F.col("logradouro")).alias("street"))


@over(f"WITH {ctes('empresa')} z AS (SELECT 1) SELECT cnpj_basico, try_cast(replace(capital_social, ',', '.') AS double) AS as_double, try_cast(replace(capital_social, ',', '.') AS decimal(18,2))::varchar AS as_decimal FROM empresa")
def f8_comma_numbers(b: Bed) -> DataFrame:
    c = F.col("capital_social")
    return b.raw["empresa"].select("cnpj_basico", types.comma_double(c).alias("as_double"), types.comma_decimal(c).cast("string").alias("as_decimal"))


@over(f"WITH {ctes('estabelecimento')} z AS (SELECT 1) SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, try_cast(numero AS integer) AS number FROM estabelecimento")
def f9_lenient_integer(b: Bed) -> DataFrame:
    return b.raw["estabelecimento"].select(products.full_id().alias("cnpj"), types.lenient_int(F.col("numero")).alias("number"))


@over(f"WITH {ctes('estabelecimento')} z AS (SELECT 1) SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, strftime(try_strptime(nullif(data_situacao_cadastral, ''), '%Y%m%d')::DATE, '%Y%m%d') AS day, CASE WHEN data_situacao_cadastral IN ('', '0') THEN NULL ELSE substr(data_situacao_cadastral, 1, 4) || '-' || substr(data_situacao_cadastral, 5, 2) || '-' || substr(data_situacao_cadastral, 7, 2) END AS iso FROM estabelecimento")
def f10_f11_f12_dates(b: Bed) -> DataFrame:
    d = F.col("data_situacao_cadastral")
    return b.raw["estabelecimento"].select(products.full_id().alias("cnpj"), F.date_format(types.compact_date(d), "yyyyMMdd").alias("day"), types.iso_date(d).alias("iso"))


@over(f"WITH {ctes('estabelecimento')} z AS (SELECT 1) SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, coalesce(array_to_string(list_transform(string_split(nullif(cnae_fiscal_secundaria, ''), ','), lambda x: trim(x)), '|'), '') AS codes, coalesce(len(string_split(nullif(cnae_fiscal_secundaria, ''), ',')), 0)::INTEGER AS n FROM estabelecimento")
def f13_f16_f17_arrays(b: Bed) -> DataFrame:
    codes = products.split_codes(F.col("cnae_fiscal_secundaria"))
    return b.raw["estabelecimento"].select(products.full_id().alias("cnpj"), F.array_join(codes, "|").alias("codes"), F.size(codes).alias("n"))


@over("SELECT p_partkey, md5(p_name) AS digest, sha256(p_brand) AS strong FROM part")
def f18_digests(b: Bed) -> DataFrame:
    return b.part.select("p_partkey", F.md5("p_name").alias("digest"), F.sha2("p_brand", 256).alias("strong"))


@over(f"WITH {ctes('socio')} z AS (SELECT 1) SELECT cnpj_cpf_socio AS masked, max(regexp_extract(cnpj_cpf_socio, '([0-9]{{6}})', 1)::BIGINT) AS six FROM socio GROUP BY 1")
def f19_masked_ids(b: Bed) -> DataFrame:
    return b.raw["socio"].groupBy(F.col("cnpj_cpf_socio").alias("masked")).agg(F.max(types.doc_masked_id(F.col("cnpj_cpf_socio"))).alias("six"))


@over("SELECT c_custkey, substr(lpad(cast(c_custkey AS varchar), 8, '0'), 1, 2) || '/' || substr(lpad(cast(c_custkey AS varchar), 8, '0'), 3, 3) || '/' || substr(lpad(cast(c_custkey AS varchar), 8, '0'), 6, 3) || '.pb' AS path FROM customer")
def f20_document_path(b: Bed) -> DataFrame:
    return b.customer.select("c_custkey", taxid.document_path(F.col("c_custkey").cast("string")).alias("path"))


def _check_sql(weights, source: str) -> str:
    total = " + ".join(f"{w} * substr({source}, {i + 1}, 1)::INTEGER" for i, w in enumerate(weights))
    return f"CASE WHEN ({total}) % 11 < 2 THEN 0 ELSE 11 - ({total}) % 11 END"


_D1, _D2 = _check_sql(taxid.WEIGHTS_1, "d"), _check_sql(taxid.WEIGHTS_2, "e")


@over(f"WITH a AS (SELECT o_orderkey, lpad(cast(o_orderkey AS varchar), 12, '0') AS d FROM orders), b AS (SELECT *, d || ({_D1})::varchar AS e FROM a), c AS (SELECT *, e || ({_D2})::varchar AS full_id FROM b) SELECT o_orderkey, full_id, o_orderkey <> 0 AS valid, substr(full_id, 1, 2) || '.' || substr(full_id, 3, 3) || '.' || substr(full_id, 6, 3) || '/' || substr(full_id, 9, 4) || '-' || substr(full_id, 13, 2) AS shown FROM c")
def f21_check_digits(b: Bed) -> DataFrame:
    d = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    df = b.orders.select("o_orderkey", F.concat(d, taxid.check_digit(d, taxid.WEIGHTS_1).cast("string")).alias("e"))
    df = df.select("o_orderkey", F.concat("e", taxid.check_digit(F.col("e"), taxid.WEIGHTS_2).cast("string")).alias("full_id"))
    return df.select("o_orderkey", "full_id", taxid.valid_id(F.col("full_id")).alias("valid"), taxid.formatted_id(F.col("full_id")).alias("shown"))


# ---- products ----

_ISO = "CASE WHEN {c} IS NULL OR {c} IN ('', '0') THEN NULL ELSE substr({c}, 1, 4) || '-' || substr({c}, 5, 2) || '-' || substr({c}, 7, 2) END"
_LABELS = "CASE situacao_cadastral WHEN '01' THEN 'Nula' WHEN '02' THEN 'Ativa' WHEN '03' THEN 'Suspensa' WHEN '04' THEN 'Inapta' WHEN '08' THEN 'Baixada' ELSE '' END"
_BOOL = "CASE {c} WHEN 'S' THEN true WHEN 'N' THEN false END"


def _wide_sql() -> str:
    new = {
        "cnpj": "cnpj_basico || cnpj_ordem || cnpj_dv",
        "cnpj_base": "cnpj_basico",
        "razao_social_normalizada": "upper(strip_accents(razao_social))",
        "natureza_juridica_codigo": "natureza_juridica",
        "natureza_juridica_descricao": "coalesce(l_n.descricao, '')",
        "qualificacao_responsavel_codigo": "qualificacao_responsavel",
        "qualificacao_responsavel_descricao": "coalesce(l_q.descricao, '')",
        "capital_social": "try_cast(replace(capital_social, ',', '.') AS double)",
        "situacao_cadastral_descricao": _LABELS,
        "motivo_situacao_cadastral_codigo": "motivo_situacao_cadastral",
        "motivo_situacao_cadastral_descricao": "coalesce(l_m.descricao, '')",
        "cnae_principal_codigo": "cnae_fiscal_principal",
        "cnae_principal_descricao": "coalesce(l_c.descricao, '')",
        "cnae_secundario_codigos": "codes",
        "cnae_secundario_descricoes": "list_transform(codes, lambda c: coalesce(cm.m[c], ''))",
        "municipio_codigo": "municipio",
        "municipio_nome": "coalesce(l_t.descricao, '')",
        "pais_codigo": "pais",
        "pais_nome": "coalesce(l_p.descricao, '')",
        "opcao_simples": _BOOL.format(c="opcao_simples"),
        "opcao_mei": _BOOL.format(c="opcao_mei"),
    }
    new |= {f.name: _ISO.format(c=f.name) for f in PRODUCT_SCHEMAS["cnpjs"] if f.name.startswith("data_")}
    columns = ", ".join(f"{new.get(f.name, f.name)} AS {f.name}" for f in PRODUCT_SCHEMAS["cnpjs"])
    return f"""
SELECT {columns}
FROM (SELECT *, CASE WHEN cnae_fiscal_secundaria = '' THEN [] ELSE list_transform(string_split(cnae_fiscal_secundaria, ','), lambda x: trim(x)) END AS codes FROM estabelecimento) e
LEFT JOIN empresa m USING (cnpj_basico) LEFT JOIN simples s USING (cnpj_basico)
LEFT JOIN lookup_naturezas l_n ON l_n.codigo = natureza_juridica LEFT JOIN lookup_qualificacoes l_q ON l_q.codigo = qualificacao_responsavel
LEFT JOIN lookup_motivos l_m ON l_m.codigo = motivo_situacao_cadastral LEFT JOIN lookup_cnaes l_c ON l_c.codigo = cnae_fiscal_principal
LEFT JOIN lookup_municipios l_t ON l_t.codigo = municipio LEFT JOIN lookup_paises l_p ON l_p.codigo = pais
CROSS JOIN (SELECT map(list(codigo), list(descricao)) AS m FROM lookup_cnaes) cm
"""


_FLAT = {f.name for f in PRODUCT_SCHEMAS["cnpjs"]} - {"cnae_secundario_codigos", "cnae_secundario_descricoes"}
_WIDE_COLUMNS = ", ".join(f"array_to_string({f.name}, '|') AS {f.name}" if f.name not in _FLAT else f.name for f in PRODUCT_SCHEMAS["cnpjs"])
_WITH_WIDE = f"WITH {ctes()} cnpjs AS ({_wide_sql()})"


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as text, so that results compare as plain values."""
    return df.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


@over(f"{_WITH_WIDE} SELECT {_WIDE_COLUMNS} FROM cnpjs")
def c1_wide_table(b: Bed) -> DataFrame:
    return _flat(products.wide_table(b.raw))


_ROLLUP = """
SELECT cnpj_base, min(razao_social) AS razao_social, min(razao_social_normalizada) AS razao_social_normalizada, min(natureza_juridica_codigo) AS natureza_juridica_codigo,
  min(natureza_juridica_descricao) AS natureza_juridica_descricao, min(capital_social) AS capital_social, min(porte_empresa) AS porte_empresa, min(ente_federativo_responsavel) AS ente_federativo_responsavel,
  count(*)::INTEGER AS qtd_estabelecimentos, (count(*) FILTER (situacao_cadastral = '02'))::INTEGER AS qtd_estabelecimentos_ativos,
  coalesce(array_to_string(list_sort(list(DISTINCT uf) FILTER (uf IS NOT NULL AND uf <> '')), '|'), '') AS ufs_atuacao,
  coalesce(array_to_string(list_sort(list(DISTINCT cnae_principal_codigo) FILTER (cnae_principal_codigo IS NOT NULL AND cnae_principal_codigo <> '')), '|'), '') AS cnaes_principais_distintos,
  arg_min(data_inicio_atividade, cnpj) FILTER (identificador_matriz_filial = '1') AS data_inicio_atividade_matriz, arg_min(uf, cnpj) FILTER (identificador_matriz_filial = '1') AS uf_matriz,
  arg_min(municipio_codigo, cnpj) FILTER (identificador_matriz_filial = '1') AS municipio_matriz_codigo, arg_min(municipio_nome, cnpj) FILTER (identificador_matriz_filial = '1') AS municipio_matriz_nome,
  arg_min(cnae_principal_codigo, cnpj) FILTER (identificador_matriz_filial = '1') AS cnae_principal_matriz_codigo, arg_min(cnae_principal_descricao, cnpj) FILTER (identificador_matriz_filial = '1') AS cnae_principal_matriz_descricao
FROM cnpjs GROUP BY cnpj_base
"""


@over(f"{_WITH_WIDE} {_ROLLUP}")
def c2_rollup(b: Bed) -> DataFrame:
    return _flat(products.root_rollup(products.wide_table(b.raw)))


_CONTACTS = """
SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, cnpj_basico AS cnpj_base, tipo, valor, posicao FROM (
  SELECT *, 'telefone' AS tipo, ddd_1 || telefone_1 AS valor, 1 AS posicao FROM estabelecimento WHERE ddd_1 <> '' AND telefone_1 <> ''
  UNION ALL SELECT *, 'telefone', ddd_2 || telefone_2, 2 FROM estabelecimento WHERE ddd_2 <> '' AND telefone_2 <> ''
  UNION ALL SELECT *, 'fax', ddd_fax || fax, 0 FROM estabelecimento WHERE ddd_fax <> '' AND fax <> ''
  UNION ALL SELECT *, 'email', correio_eletronico, 0 FROM estabelecimento WHERE correio_eletronico <> '')
"""


@over(f"WITH {ctes('estabelecimento')} z AS (SELECT 1) {_CONTACTS}")
def c3_contacts(b: Bed) -> DataFrame:
    return products.contact_index(b.raw)


_CNAES = """
SELECT a.cnpj, a.cnpj_base, a.cnae_codigo, l.descricao AS cnae_descricao, a.posicao FROM (
  SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, cnpj_basico AS cnpj_base, cnae_fiscal_principal AS cnae_codigo, 0 AS posicao FROM estabelecimento WHERE cnae_fiscal_principal <> ''
  UNION ALL SELECT cnpj, cnpj_base, trim(x), i::INTEGER FROM (SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, cnpj_basico AS cnpj_base, unnest(string_split(cnae_fiscal_secundaria, ',')) AS x,
    unnest(range(1, 1 + len(string_split(cnae_fiscal_secundaria, ',')))) AS i FROM estabelecimento WHERE cnae_fiscal_secundaria <> '')) a
LEFT JOIN lookup_cnaes l ON l.codigo = a.cnae_codigo
"""


@over(f"WITH {ctes('estabelecimento', 'lookup_cnaes')} z AS (SELECT 1) {_CNAES}")
def c4_activities(b: Bed) -> DataFrame:
    return products.activity_index(b.raw)


_ADDRESSES = f"""b AS (SELECT e.*, e.cnpj_basico || e.cnpj_ordem || e.cnpj_dv AS cnpj, l.descricao AS municipio_nome, upper(strip_accents(trim(regexp_replace(logradouro, '\\s+', ' ', 'g')))) AS s
  FROM estabelecimento e LEFT JOIN lookup_municipios l ON l.codigo = e.municipio WHERE logradouro <> '' AND uf <> '')
{_STREET.format(key="uf, municipio AS municipio_codigo, municipio_nome, numero, cep, bairro, cnpj", name="logradouro_normalizado")} FROM b"""


@over(f"WITH {ctes('estabelecimento', 'lookup_municipios')} {_ADDRESSES}")
def c5_addresses(b: Bed) -> DataFrame:
    return products.address_index(b.raw)


_PEOPLE = """
SELECT s.*, q.descricao AS qualificacao_descricao FROM (
  SELECT cnpj_cpf_socio AS cpf_mascarado, upper(strip_accents(trim(nome_socio_razao_social))) AS nome_normalizado, nome_socio_razao_social AS nome_original, 'socio_pf' AS papel, cnpj_basico AS cnpj_base,
    qualificacao_socio AS qualificacao_codigo, faixa_etaria FROM socio WHERE identificador_socio = '2' AND cnpj_cpf_socio <> ''
  UNION ALL SELECT DISTINCT representante_legal, upper(strip_accents(trim(nome_representante_legal))), nome_representante_legal, 'representante', cnpj_basico, qualificacao_representante_legal, CAST(NULL AS varchar)
    FROM socio WHERE representante_legal <> '') s
LEFT JOIN lookup_qualificacoes q ON q.codigo = s.qualificacao_codigo
"""


@over(f"WITH {ctes('socio', 'lookup_qualificacoes')} z AS (SELECT 1) {_PEOPLE}")
def c6_people(b: Bed) -> DataFrame:
    return products.people_index(b.raw)


_PARTNERS = f"""
SELECT cnpj_basico AS cnpj_base, identificador_socio AS tipo, CASE identificador_socio WHEN '1' THEN 'PJ' WHEN '2' THEN 'PF' WHEN '3' THEN 'estrangeiro' ELSE '' END AS tipo_descricao, nome_socio_razao_social,
  CASE WHEN identificador_socio = '2' THEN cnpj_cpf_socio END AS cpf_mascarado, CASE WHEN identificador_socio = '1' THEN cnpj_cpf_socio END AS cnpj_socio, qualificacao_socio AS qualificacao_codigo,
  coalesce(a.descricao, '') AS qualificacao_descricao, {_ISO.format(c='data_entrada_sociedade')} AS data_entrada_sociedade, pais AS pais_codigo, coalesce(p.descricao, '') AS pais_nome,
  representante_legal AS representante_legal_cpf, nome_representante_legal AS representante_legal_nome, qualificacao_representante_legal AS representante_legal_qualificacao_codigo,
  coalesce(r.descricao, '') AS representante_legal_qualificacao_descricao, faixa_etaria
FROM socio LEFT JOIN lookup_qualificacoes a ON a.codigo = qualificacao_socio LEFT JOIN lookup_qualificacoes r ON r.codigo = qualificacao_representante_legal LEFT JOIN lookup_paises p ON p.codigo = pais
"""


@over(f"WITH {ctes('socio', 'lookup_qualificacoes', 'lookup_paises')} z AS (SELECT 1) {_PARTNERS}")
def c7_partners(b: Bed) -> DataFrame:
    return products.partner_table(b.raw)


# ---- quality ----

_CONFLICTS = """
SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT {'p': l_partkey, 's': l_suppkey, 'q': l_quantity, 'f': l_returnflag}) AS variants
FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT {'p': l_partkey, 's': l_suppkey, 'q': l_quantity, 'f': l_returnflag}) > 1
"""


@over(_CONFLICTS)
def c12_conflicting_keys(b: Bed) -> DataFrame:
    df = b.lineitem.withColumn("l_orderkey", F.col("l_orderkey").cast("string")).withColumn("l_linenumber", F.col("l_linenumber").cast("string"))
    out = quality.conflicting_keys(df, ("l_orderkey", "l_linenumber"), ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag"])
    return out.select(F.col("l_orderkey").cast("long"), F.col("l_linenumber").cast("int"), "n", "variants")


@over(f"WITH {ctes('empresa')} z AS (SELECT 1) SELECT count(*) FILTER (trim(capital_social) <> '' AND try_cast(replace(capital_social, ',', '.') AS decimal(18,2)) IS NULL) AS capital, count(*) FILTER (trim(razao_social) <> '' AND try_cast(razao_social AS integer) IS NULL) AS name FROM empresa")
def c13_invalid_casts(b: Bed) -> DataFrame:
    return quality.invalid_casts(b.raw["empresa"], {"capital": ("capital_social", "try_cast(replace(capital_social, ',', '.') AS decimal(18,2))"), "name": ("razao_social", "try_cast(razao_social AS int)")})


@over(f"{_WITH_WIDE} SELECT (SELECT count(*) FROM cnpjs) AS rows_compared, 0::BIGINT AS differing")
def c15_roundtrip(b: Bed) -> DataFrame:
    from .lifecycle import ROUND_TRIP

    raw = b.raw
    source = raw["estabelecimento"].withColumn("cnpj", products.full_id())
    return quality.round_trip(source, products.wide_table(raw), ("cnpj",), ROUND_TRIP)


_NESTED = f"""
, sites AS (SELECT cnpj_base, array_to_string(list(try_cast(cnpj_ordem AS bigint)::varchar || ':' || CASE WHEN identificador_matriz_filial = '1' THEN '1' ELSE '2' END ORDER BY cnpj_ordem, cnpj_dv), ',') AS sites, count(*) AS n_sites FROM cnpjs GROUP BY 1),
p AS ({_PARTNERS}),
people AS (SELECT cnpj_base, array_to_string(list(trim(nome_socio_razao_social) ORDER BY qualificacao_codigo NULLS LAST, nome_socio_razao_social NULLS LAST, cnpj_socio NULLS LAST, cpf_mascarado NULLS LAST, data_entrada_sociedade NULLS LAST, tipo NULLS LAST), ',') AS partners FROM p GROUP BY 1)
SELECT cast(s.cnpj_base AS bigint) AS cnpj_base, s.sites, s.n_sites, coalesce(people.partners, '') AS partners FROM sites s LEFT JOIN people USING (cnpj_base)
"""


@over(_WITH_WIDE + _NESTED)
def c17_nested_documents(b: Bed) -> DataFrame:
    raw = b.raw
    roots = products.root_rollup(products.wide_table(raw), site_rows=documents.site_rows())
    docs = documents.company_documents(roots, None, products.partner_table(raw), "2026-04")
    site = lambda e: F.concat(e["cnpj_ordem"].cast("string"), F.lit(":"), e["tipo"].cast("string"))
    return docs.select("cnpj_base", F.array_join(F.transform("estabelecimentos", site), ",").alias("sites"), F.size("estabelecimentos").cast("long").alias("n_sites"), F.array_join(F.transform("socios", lambda s: s["nome_socio_razao_social"]), ",").alias("partners"))


@over("SELECT 0::BIGINT AS only_left, 0::BIGINT AS only_right")
def c18_equivalent_plans(b: Bed) -> DataFrame:
    """The rollup in one grouping, and from separately grouped parts joined on the root."""
    wide = products.wide_table(b.raw)
    one = products.root_rollup(wide)
    counts = wide.groupBy("cnpj_base").agg(F.count("*").cast("int").alias("qtd_estabelecimentos"), F.count_if(F.col("situacao_cadastral") == "02").cast("int").alias("qtd_estabelecimentos_ativos"))
    states = wide.filter(text.filled(F.col("uf"))).select("cnpj_base", "uf").distinct().groupBy("cnpj_base").agg(F.array_sort(F.collect_list("uf")).alias("ufs_atuacao"))
    w = Window.partitionBy("cnpj_base").orderBy("cnpj")
    seat = wide.filter("identificador_matriz_filial = '1'").withColumn("r", F.row_number().over(w)).filter("r = 1").select("cnpj_base", F.col("uf").alias("uf_matriz"))
    empty = F.array().cast("array<string>")
    two = counts.join(states, "cnpj_base", "left").join(seat, "cnpj_base", "left").withColumn("ufs_atuacao", F.coalesce("ufs_atuacao", empty))
    return quality.bag_difference(one.select(*two.columns), two)


@over("SELECT count(*) AS n, sum(('0x' || substr(sha256(to_json({'n_nationkey': n_nationkey, 'n_name': n_name})), 1, 12))::BIGINT)::VARCHAR AS checksum FROM nation")
def a15_unordered_checksum(b: Bed) -> DataFrame:
    return quality.checksum(b.nation, ["n_nationkey", "n_name"]).withColumn("checksum", F.col("checksum").cast("string"))


# ---- searches and views ----


def _card_sql(where: str, tail: str) -> str:
    return f"{_WITH_WIDE} SELECT {', '.join(search._CARD)} FROM cnpjs WHERE {where} {tail}"


@over(_card_sql("cnpj = (SELECT max(cnpj_basico || cnpj_ordem || cnpj_dv) FROM estabelecimento)", "LIMIT 1"))
def q1_by_id(b: Bed) -> DataFrame:
    raw = b.raw
    wanted = raw["estabelecimento"].agg(F.max(taxid.formatted_id(products.full_id())).alias("id")).first()["id"]
    return search.by_id(products.wide_table(raw), wanted)


@over(_card_sql("contains(razao_social_normalizada, 'SAO JOAO')", "ORDER BY razao_social, cnpj LIMIT 20"))
def q2_by_company_name(b: Bed) -> DataFrame:
    return search.by_company_name(products.wide_table(b.raw), "São João%")


def _address_sql(where: str, order: str) -> str:
    return f"WITH {ctes('estabelecimento', 'lookup_municipios')} {_ADDRESSES.replace('b AS', 'enderecos AS (WITH b AS', 1)}) SELECT cnpj, uf, municipio_codigo, logradouro_normalizado, numero, bairro, cep FROM enderecos WHERE {where} ORDER BY {order} LIMIT 50"


@over(_address_sql("cep = '00000042'", "uf, logradouro_normalizado, numero, cnpj"))
def q3_by_postal_code(b: Bed) -> DataFrame:
    return search.by_address(products.address_index(b.raw), "00000-042")


@over(_address_sql("contains(logradouro_normalizado, 'PRACA') AND uf = 'SP'", "logradouro_normalizado, numero, cnpj"))
def q4_by_street(b: Bed) -> DataFrame:
    return search.by_address(products.address_index(b.raw), "praça", uf="SP")


_WITH_CNAES = f"{_WITH_WIDE}, cnpj_cnaes AS ({_CNAES})"
_CODE_7 = "cnae_codigo = '7'"
_TEXT_RING = "cnae_codigo IN (SELECT codigo FROM lookup_cnaes WHERE contains(upper(strip_accents(descricao)), 'RING E'))"
_BY_CNAE = "SELECT cc.cnpj, c.razao_social, c.nome_fantasia, c.uf, c.municipio_nome, cc.cnae_codigo, cc.posicao FROM (SELECT cnpj, cnae_codigo, posicao FROM cnpj_cnaes WHERE {where} ORDER BY cnae_codigo, posicao, cnpj LIMIT 30) cc JOIN cnpjs c USING (cnpj)"


@over(f"{_WITH_CNAES} {_BY_CNAE.format(where=_CODE_7)}")
def q5_by_activity_code(b: Bed) -> DataFrame:
    raw = b.raw
    return search.by_activity(products.activity_index(raw), products.wide_table(raw), raw["lookup_cnaes"], "7")


@over(f"{_WITH_CNAES} {_BY_CNAE.format(where=_TEXT_RING)}")
def q6_by_activity_text(b: Bed) -> DataFrame:
    raw = b.raw
    return search.by_activity(products.activity_index(raw), products.wide_table(raw), raw["lookup_cnaes"], "ring é")


_WITH_PEOPLE = f"WITH {ctes('socio', 'lookup_qualificacoes')} pessoas AS ({_PEOPLE})"


@over(f"{_WITH_PEOPLE} SELECT cpf_mascarado, nome_normalizado, nome_original, papel, cnpj_base, qualificacao_codigo, faixa_etaria FROM pessoas WHERE contains(nome_normalizado, 'ANA O') ORDER BY cpf_mascarado, nome_normalizado, cnpj_base, papel LIMIT 50")
def q7_by_person(b: Bed) -> DataFrame:
    # A root has an agent once a qualification: ties that the SQL leaves open, in which it gives other rows from run to run.
    return search.by_person(products.people_index(b.raw), "ana ö")


@over(f"WITH {ctes('socio', 'lookup_qualificacoes', 'lookup_paises')} socios AS ({_PARTNERS}) SELECT * FROM socios WHERE cnpj_base = '00000042'")
def q8_partners_of(b: Bed) -> DataFrame:
    return search.partners_of(products.partner_table(b.raw), "00000042")


@over(f"WITH {ctes('estabelecimento')} c AS ({_CONTACTS}) SELECT tipo, valor, posicao FROM c WHERE cnpj = (SELECT min(cnpj) FROM c)")
def q9_contacts_of(b: Bed) -> DataFrame:
    index = products.contact_index(b.raw)
    first = index.agg(F.min("cnpj").alias("cnpj"))
    return index.join(F.broadcast(first), "cnpj", "left_semi").select("tipo", "valor", "posicao")  # one row


@over(f"{_WITH_WIDE} SELECT cnpj, razao_social, nome_fantasia, uf, municipio_nome, situacao_cadastral FROM cnpjs WHERE cnpj_base = '00000007' AND cnpj <> '00000007000100' ORDER BY cnpj LIMIT 50")
def q10_siblings(b: Bed) -> DataFrame:
    return search.siblings_of(products.wide_table(b.raw), "00000007000100")


@over(f"{_WITH_WIDE} SELECT cnpj, cnpj_base, uf FROM cnpjs WHERE situacao_cadastral = '02'")
def q11_active(b: Bed) -> DataFrame:
    from .views import VIEWS

    wide = products.wide_table(b.raw)
    return b.spark.sql(VIEWS["empresas_ativas"].sql.replace("cnpjs", "{cnpjs}"), cnpjs=wide).select("cnpj", "cnpj_base", "uf")


@over(f"{_WITH_WIDE}, socios AS ({_PARTNERS}) SELECT s.* FROM socios s WHERE cnpj_base IN (SELECT cnpj_base FROM cnpjs WHERE situacao_cadastral = '02')")
def q12_partners_of_active(b: Bed) -> DataFrame:
    from .views import VIEWS

    raw = b.raw
    sql = VIEWS["socios_de_raizes_ativas"].sql.replace("FROM socios", "FROM {socios}").replace("FROM raizes", "FROM {raizes}")
    return b.spark.sql(sql, socios=products.partner_table(raw), raizes=products.root_rollup(products.wide_table(raw)))


@over(f"{_WITH_WIDE} SELECT uf, count(DISTINCT cnpj_base) AS qtd_raizes FROM cnpjs WHERE uf <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def q14_roots_per_state(b: Bed) -> DataFrame:
    return search.roots_per_state(products.root_rollup(products.wide_table(b.raw)))


@over(f"WITH {ctes('estabelecimento', 'lookup_cnaes')} cc AS ({_CNAES}) SELECT cc.*, upper(strip_accents(l.descricao)) AS descricao_normalizada FROM cc JOIN lookup_cnaes l ON l.codigo = cc.cnae_codigo WHERE posicao = 0 AND contains(upper(strip_accents(l.descricao)), 'WIDGET') ORDER BY cnae_codigo, cnpj LIMIT 20")
def q15_main_activity_text(b: Bed) -> DataFrame:
    raw = b.raw
    return search.main_activity_containing(products.activity_index(raw), raw["lookup_cnaes"], "widget")


@over(f"{_WITH_PEOPLE} SELECT DISTINCT b.cnpj_base, b.papel, a.nome_normalizado AS via FROM pessoas a JOIN pessoas b ON a.cpf_mascarado = b.cpf_mascarado AND a.nome_normalizado = b.nome_normalizado WHERE a.cnpj_base = '00000042' AND b.cnpj_base <> '00000042'")
def q16_connected_roots(b: Bed) -> DataFrame:
    return search.connected_roots(products.people_index(b.raw), "00000042")


@over(f"WITH {ctes('lookup_qualificacoes')} z AS (SELECT 1) SELECT codigo, descricao, upper(strip_accents(descricao)) AS descricao_normalizada FROM lookup_qualificacoes")
def q17_k6_lookup_normalised(b: Bed) -> DataFrame:
    return products.lookup_table(b.raw["lookup_qualificacoes"])


@over(f"WITH {ctes('estabelecimento')} c AS ({_CONTACTS}) SELECT tipo, valor, count(DISTINCT cnpj) AS n FROM c GROUP BY 1, 2 HAVING count(DISTINCT cnpj) > 1")
def q18_shared_contacts(b: Bed) -> DataFrame:
    return search.shared_contacts(products.contact_index(b.raw))


@over(f"WITH {ctes('estabelecimento')} c AS ({_CONTACTS}) SELECT tipo, cnpj, posicao FROM c WHERE valor = '1100000042'")
def q18_reverse_contact(b: Bed) -> DataFrame:
    return search.reverse_contact(products.contact_index(b.raw), "1100000042").select("tipo", "cnpj", "posicao")


@over(f"{_WITH_WIDE}, r AS (SELECT DISTINCT cnpj_base FROM cnpjs WHERE uf = 'MG' ORDER BY sha256(cnpj_base), cnpj_base LIMIT 20) SELECT cnpj_base, count(*)::INTEGER AS sites FROM cnpjs WHERE cnpj_base IN (SELECT cnpj_base FROM r) GROUP BY 1")
def q19_sample_with_children(b: Bed) -> DataFrame:
    raw = b.raw
    wide = products.wide_table(raw)
    out = search.sample_with_children(products.root_rollup(wide), wide, products.partner_table(raw), "MG", 20)
    return out.select("cnpj_base", F.size("estabelecimentos").alias("sites"))


@over(f"WITH {ctes('estabelecimento', 'lookup_cnaes')} cc AS ({_CNAES}) SELECT cc.cnpj, cc.cnae_codigo, cc.posicao FROM cc JOIN lookup_cnaes l ON l.codigo = cc.cnae_codigo WHERE starts_with(upper(strip_accents(l.descricao)), 'SMALL') ORDER BY cnae_codigo, posicao, cnpj LIMIT 50")
def q22_activity_prefix(b: Bed) -> DataFrame:
    raw = b.raw
    return search.activity_starting(products.activity_index(raw), raw["lookup_cnaes"], "small").select("cnpj", "cnae_codigo", "posicao")


@over(f"WITH {ctes('estabelecimento', 'lookup_cnaes')} cc AS ({_CNAES}) SELECT b.cnae_codigo, count(*) AS n FROM cc b WHERE posicao = 1 AND cnpj IN (SELECT cnpj FROM cc WHERE posicao = 0 AND cnae_codigo = '3') GROUP BY 1")
def q23_usual_second_activity(b: Bed) -> DataFrame:
    return search.usual_second_activity(products.activity_index(b.raw), "3")


@over(f"WITH {ctes('estabelecimento')} c AS ({_CONTACTS}) SELECT lower(split_part(valor, '@', 2)) AS dominio, count(*) AS n FROM c WHERE tipo = 'email' GROUP BY 1")
def q24_mail_domains(b: Bed) -> DataFrame:
    return search.mail_domains(products.contact_index(b.raw))


@over(" UNION ALL ".join(["WITH " + ctes("estabelecimento") + " z AS (SELECT 1) SELECT 'uf' AS \"column\", count(*) AS rows, count(*) FILTER (trim(uf) = '') AS blank FROM estabelecimento", "SELECT 'fax', count(*), count(*) FILTER (trim(fax) = '') FROM estabelecimento"]))
def c13_column_profile(b: Bed) -> DataFrame:
    return quality.column_profile(b.raw["estabelecimento"], ["uf", "fax"])

