"""The pN_ queries of the operators for training data, and their SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import clusters, defects, encode, knn, leaks, neardup, pieces, privacy
from inkwell.session import table


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question and answer of the rows of the cache that have a pair."""
    cache = table(spark, sf_dir, "qa_cache").filter(F.col("response.qa").isNotNull())
    return cache.select("qa_id", F.col("response.qa.question").alias("question"), F.col("response.qa.answer").alias("answer"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_pairs(_pairs(spark, sf_dir), "qa_id", [F.col("question"), F.col("answer")])


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(_pairs(spark, sf_dir), "qa_id", [F.col("question"), F.col("answer")])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces.split_texts(table(spark, sf_dir, "dataset"), with_text=False)
    return cut.filter(F.col("piece") == 2).select("row_id").distinct()


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.split_texts(table(spark, sf_dir, "dataset"))


def p2_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of every text's pieces: in order, within the limit, overlapping by 300 characters at most, and nothing lost or changed."""
    rows = table(spark, sf_dir, "dataset").select("row_id", F.col("text").alias("whole"))
    cut = pieces.split_texts(table(spark, sf_dir, "dataset")).distinct().join(rows, "row_id")
    within = (F.col("end") - F.col("start") <= 6000) & (F.col("text") == F.expr("substring(whole, start + 1, end - start)")) & (F.length("text") == F.col("end") - F.col("start"))
    each = cut.select("row_id", "whole", "pieces", within.alias("fits"), F.struct("piece", "start", "end").alias("p"))
    found = each.groupBy("row_id", F.length("whole").alias("characters")).agg(F.array_sort(F.collect_list("p")).alias("p"), F.min("fits").alias("fits"), F.max("pieces").alias("pieces"))
    joins = F.forall(F.sequence(F.lit(1), F.size("p")), lambda i: (i == 1) | (F.get("p", i - 1)["start"] <= F.get("p", i - 2)["end"]) & (F.get("p", i - 1)["start"] >= F.get("p", i - 2)["end"] - 300) & (F.get("p", i - 1)["end"] > F.get("p", i - 2)["end"]))
    ends = (F.get("p", F.lit(0))["start"] == 0) & (F.get("p", F.size("p") - 1)["end"] == F.col("characters")) & (F.size("p") == F.col("pieces"))
    return found.select("row_id", F.col("characters").cast("bigint").alias("characters"), (F.size("p") > 1).alias("cut"), (F.col("fits") & joins & ends).alias("whole"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.similarity_clusters(table(spark, sf_dir, "dataset")).select("cluster_id", "row_id")


def p4_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cluster's size and three most typical rows."""
    members = clusters.similarity_clusters(table(spark, sf_dir, "dataset"))
    return members.filter(F.col("typical") <= 3).withColumn("affinity", F.round("affinity", 6))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.defects(_pairs(spark, sf_dir), table(spark, sf_dir, "documents")).distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.similar_pairs(knn.nearest_rows(table(spark, sf_dir, "dataset")))


def p7_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.nearest_rows(table(spark, sf_dir, "dataset"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_corpus(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "qa_test"))
    return windows.select("doc_id", "item_id").distinct()


def p9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks with up to one substituted word in a window, and how many words leaked in a stretch."""
    windows = leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "qa_test"), substitutions=1)
    return leaks.leaked_items(windows)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = privacy.given_names(table(spark, sf_dir, "article_meta"), "authors")
    return privacy.find_personal(table(spark, sf_dir, "documents"), given).select("doc_id", "kind", "pii").distinct()


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = privacy.given_names(table(spark, sf_dir, "article_meta"), "authors")
    return privacy.redact_texts(table(spark, sf_dir, "documents"), given)


QUERIES = {f.__name__: f for f in (p1_found, p1_groups, p2_found, p2_pieces, p2_whole, p4_found, p4_clusters, p6_found, p7_found, p7_knn, p8_ids, p9_found, p9_near, p10_found, p10_redacted)}

_WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"

# Brute force over whole tables, for the problems that SQL can state.
_USABLE = """v as (select row_id, cast(embed as double[]) as e from dataset
where embed is not null and len(embed) = 128 and len(list_filter(embed, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embed, lambda x: x <> 0)) > 0),
s as (select a.row_id as a, b.row_id as b, list_cosine_similarity(a.e, b.e) as c from v a join v b on a.row_id <> b.row_id)"""

_GRAMS = "unnest(list_transform(range(1, greatest(len(w) - 10, 1)), lambda i: array_to_string(w[i:i + 11], ' ')))"

ORACLE_SQL: dict[str, str] = {
    "p1_found": f"""with w as (select qa_id, list_distinct({_WORDS.format("concat_ws(' ', response.qa.question, response.qa.answer)")}) as w from qa_cache where response.qa is not null),
p as (select a.qa_id as qa_id_a, b.qa_id as qa_id_b, len(a.w) + len(b.w) as n, len(list_intersect(a.w, b.w)) as i from w a join w b on a.qa_id < b.qa_id where len(a.w) > 0 and len(b.w) > 0)
select qa_id_a, qa_id_b from p where i >= 0.8 * (n - i) - 1e-9""",
    "p2_found": "select distinct row_id from dataset where length(text) > 6000",
    "p2_whole": "select distinct row_id, length(text) as characters, length(text) > 6000 as cut, true as whole from dataset where text is not null",
    "p4_found": f"""with {_USABLE},
n as (select a, least(a, min(b)) as cluster_id, count(*) + 1 as size from s where c >= 0.75 group by a)
select cluster_id, a as row_id from n qualify size >= 3 and count(*) over (partition by cluster_id) = size and min(size) over (partition by cluster_id) = size""",
    "p4_clusters": f"""with {_USABLE},
n as (select a, least(a, min(b)) as cluster_id, count(*) + 1 as size from s where c >= 0.75 group by a),
m as (select cluster_id, a as row_id, size from n qualify size >= 3 and count(*) over (partition by cluster_id) = size and min(size) over (partition by cluster_id) = size),
x as (select m.*, v.e, min(m.row_id) over (partition by cluster_id, v.e) as rep from m join v using (row_id)),
t as (select a.cluster_id, a.row_id as rep, coalesce(avg(list_cosine_similarity(a.e, b.e)), 1.0) as affinity from x a left join x b on a.cluster_id = b.cluster_id and b.row_id = b.rep and b.rep <> a.rep where a.row_id = a.rep group by all)
select x.cluster_id, x.row_id, x.size, cast(row_number() over (partition by x.cluster_id order by round(affinity, 9) desc, x.row_id) as int) as typical, round(affinity, 6) as affinity
from x join t using (cluster_id, rep) qualify typical <= 3""",
    "p7_found": f"""with {_USABLE}, k as (select a, b, c from s qualify row_number() over (partition by a order by c desc, b) <= 5)
select distinct least(a, b) as row_id_a, greatest(a, b) as row_id_b from k where c >= 0.75""",
    "p9_near": f"""with d as (select doc_id, {_WORDS.format('text')} as w from documents where text is not null),
i as (select item_id, 'q' as field, {_WORDS.format('question')} as w from qa_test union all select item_id, 'a', {_WORDS.format('answer')} from qa_test),
dw as (select doc_id, {_GRAMS} as g, unnest(range(1, greatest(len(w) - 10, 1))) as pos from d where len(w) >= 12), iw as (select item_id, field, {_GRAMS} as g, unnest(range(1, greatest(len(w) - 10, 1))) as item_pos from i where len(w) >= 12),
p as (select unnest(range(0, 12)) as x),
dk as (select doc_id, pos, x, array_to_string(list_transform(string_split(g, ' '), lambda v, n: case when n = x + 1 then '' else v end), ' ') as k from dw, p),
ik as (select item_id, field, item_pos, x, array_to_string(list_transform(string_split(g, ' '), lambda v, n: case when n = x + 1 then '' else v end), ' ') as k from iw, p),
h as (select distinct doc_id, item_id, field, pos, item_pos from dk join ik using (x, k)),
b as (select *, pos - item_pos as shift, coalesce(pos - lag(pos) over (partition by doc_id, item_id, field, pos - item_pos order by pos) > 12, true) as begins from h),
s as (select *, sum(cast(begins as int)) over (partition by doc_id, item_id, field, shift order by pos rows unbounded preceding) as stretch from b),
e as (select doc_id, item_id, max(pos) - min(pos) + 12 as words from s group by doc_id, item_id, field, shift, stretch)
select doc_id, item_id, cast(max(words) as int) as words from e group by doc_id, item_id""",
    "p1_groups": f"""with recursive w as (select qa_id, list_sort(list_distinct({_WORDS.format("concat_ws(' ', response.qa.question, response.qa.answer)")})) as w from qa_cache where response.qa is not null),
c as (select qa_id, w, min(qa_id) over (partition by w) as rep from w), r as (select distinct rep, w from c),
e as (select a.rep as u, b.rep as v from r a join r b on a.rep <> b.rep and len(a.w) > 0 and len(b.w) > 0 and len(list_intersect(a.w, b.w)) >= 0.8 * (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) - 1e-9),
g(rep, node) as (select rep, rep from r union select g.rep, e.v from g join e on e.u = g.node)
select c.qa_id, x.group_id, coalesce(l.n, 0) as links from c join (select rep, min(node) as group_id from g group by rep) x using (rep) left join (select u as rep, count(*) as n from e group by u) l using (rep)""",
    "p9_found": f"""with d as (select doc_id, {_WORDS.format('text')} as w from documents where text is not null), i as (select item_id, {_WORDS.format('question')} as w from qa_test union all select item_id, {_WORDS.format('answer')} from qa_test),
dg as (select distinct doc_id, {_GRAMS} as g from d where len(w) >= 12), ig as (select distinct item_id, {_GRAMS} as g from i where len(w) >= 12)
select distinct doc_id, item_id from dg join ig using (g)""",
}
