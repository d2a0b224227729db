"""Named queries over the test tables and their SQL.

Where the tables lack the shape an operator needs (XML, genes, tags), the input
is made from their columns, in the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import markup as M
from inkwell.functions import text as T
from inkwell.functions import vector as V
from inkwell.operators import cliques, concepts, expand, filters, nested, packed, relational, reshape
from inkwell.plans import embed as embed_plan
from inkwell.plans import qa as qa_plan
from inkwell.plans.ingest import with_status
from inkwell.plans.render import to_markdown
from inkwell.providers import HashEmbedder, ScriptedModel
from inkwell.schemas import RECORD
from inkwell.session import spread, table
from inkwell.sources import jats, jsonl, listing
from inkwell.streaming.ingest import windowed_counts

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with the SQL that DuckDB runs on the same tables."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# -- SQL building blocks ------------------------------------------------------------------------

_B = r"[\t-\r\x{85}\p{Z}]"


def _sql_replace(text: str, *steps: tuple[str, str]) -> str:
    for pattern, replacement in steps:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


def _sql_strip(text: str) -> str:
    return _sql_replace(text, (f"^{_B}+|{_B}+$", ""))


def _sql_normalize(text: str) -> str:
    return _sql_replace(
        text, (f"{_B}+", " "), (r"\( ?([0-9 ,-]+?) ?\)", r"[\1]"), (r"\[ +", "["), (r" +\]", "]"), (r"\( +", "("), (r" +\)", ")"), (r" +([.,;:?!])", r"\1"), ("^ +| +$", "")
    )


def _sql_lines(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '\\r\\n|\\r|\\n'), lambda s: {_sql_strip('s')} <> '')"


def _sql_sentences(text: str) -> str:
    marked = f"regexp_replace({text}, '([.!?]+){_B}+', '\\1' || chr(1), 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {_sql_strip('s')}), lambda s: s <> '')"


_SENTENCES = f"""
lined as (select doc_id, lang, source, unnest({_sql_lines('text')}) as line, generate_subscripts({_sql_lines('text')}, 1) as paragraph from documents where text is not null),
listed as (select doc_id, lang, source, paragraph, {_sql_sentences(_sql_normalize('line'))} as s from lined),
said as (select doc_id, lang, source, paragraph, unnest(s) as text, generate_subscripts(s, 1) as sentence from listed)
"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, over every core where their file has few row groups."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


# -- Texts --------------------------------------------------------------------------------------


@query(f"""with {_SENTENCES}
select lang, source, count(distinct doc_id) as docs, count(distinct (doc_id, paragraph)) as paragraphs, count(*) as sentences,
       cast(sum(length(text)) as bigint) as characters from said group by lang, source""")
def sentence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, paragraphs, sentences and characters of each language and source."""
    by_line = F.filter(F.transform(T.lines(F.col("text")), lambda line: T.sentences(T.normalize_paragraph(line))), lambda said: F.size(said) > 0)
    # Counted within each document: nothing is exploded, and only the totals are shuffled.
    said = _documents(spark, sf_dir).select("lang", "source", by_line.alias("s"))
    characters = F.aggregate(F.flatten("s"), F.lit(0), lambda total, x: total + F.length(x))
    each = said.select("lang", "source", F.size("s").alias("p"), F.size(F.flatten("s")).alias("n"), characters.alias("c"))
    # A filter here would move below the spread and do the whole work twice.
    totals = each.groupBy("lang", "source").agg(F.count_if(F.col("p") > 0).alias("docs"), F.sum("p").alias("paragraphs"), F.sum("n").alias("sentences"), F.sum("c").alias("characters"))
    return totals.filter("docs > 0")


@query(f"select doc_id, md5({_sql_normalize('text')}) as digest, length({_sql_normalize('text')}) as characters from documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).select("doc_id", T.normalize_paragraph(F.col("text")).alias("t"))
    return rows.select("doc_id", F.md5("t").alias("digest"), F.length("t").cast("bigint").alias("characters"))


@query(f"with {_SENTENCES} select doc_id, paragraph, sentence, text from said")
def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = expand.sentence_rows(_documents(spark, sf_dir), "doc_id")
    return rows.select("doc_id", F.col("paragraph").cast("bigint").alias("paragraph"), F.col("sentence").cast("bigint").alias("sentence"), "text")


@query(r"""select distinct doc_id, unnest(regexp_extract_all(text, '\bliver\b|\bkidney\b|\bgene\b', 0)) as match from documents where regexp_matches(text, '\bliver\b|\bkidney\b|\bgene\b')""")
def separate_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand.separate_text(_documents(spark, sf_dir), ["liver", "kidney", "gene"]).select("doc_id", "match")


@query(r"select distinct doc_id, unnest(regexp_extract_all(text, 'p [<>=] [0-9.]+[0-9]', 0)) as match from documents where text is not null")
def separate_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand.separate_text(_documents(spark, sf_dir), r"p [<>=] [0-9.]+[0-9]").select("doc_id", "match")


@query(r"""with m as (select distinct doc_id, unnest(regexp_extract_all(text, '(?:\(|\[)[0-9, -]+(?:\]|\))', 0)) as match from documents where text is not null),
i as (select doc_id, match, unnest(string_split(regexp_replace(match, '[\[\]() ]', '', 'g'), ',')) as item from m),
e as (select doc_id, match, string_split(item, '-') as ends from i),
n as (select doc_id, match, len(ends) as k, try_cast(ends[1] as int) as a, try_cast(ends[2] as int) as b from e)
select doc_id, match, a as id from n where k = 1 and a is not null
union all select doc_id, match, cast(unnest(generate_series(a, b)) as int) from n where k = 2 and a <= b""")
def separate_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand.separate_refs(_documents(spark, sf_dir)).select("doc_id", "match", "id")


_GENE_TEXT = "concat('Loss of ', substr(lower(p_name), 1, 3), 'ABC and rpoB near ', p_name, ' with log2 and xyzA', p_partkey % 1000, '.')"


@query(rf"""with m as (select distinct p_partkey, unnest(regexp_extract_all({_GENE_TEXT}, '\b[A-Za-z][a-z]{{2}}[A-Z0-9]+\b', 0)) as match from part),
k as (select * from m where match not in ('TraDIS','taqDNA','log2','log10','ecoRI','bamHI','chr1','chr2'))
select p_partkey, match, lower(match[1:3]) || unnest(string_split(match[4:], '')) as gene from k where length(match) >= 6 and not regexp_full_match(match[4:], '[0-9]+')
union all select p_partkey, match, lower(match[1:1]) || match[2:] from k where not (length(match) >= 6 and not regexp_full_match(match[4:], '[0-9]+'))""")
def separate_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(_GENE_TEXT).alias("text"))
    return expand.separate_genes(rows).select("p_partkey", "match", "gene")


_TAG_TEXT = "concat('From AB', lpad(cast(o_orderkey % 9000 as string), 4, '0'), '-', lpad(cast(o_orderkey % 100 as string), 2, '0'), ' to AB', lpad(cast(o_custkey % 10000 as string), 4, '0'), '.')"


@query(f"""with t as (select o_orderkey, {_TAG_TEXT.replace('as string', 'as varchar')} as text from orders),
m as (select distinct o_orderkey, unnest(regexp_extract_all(text, 'AB[0-9AB-]+', 0)) as match from t),
s as (select o_orderkey, match, string_split(regexp_replace(match, '-+$', ''), '-') as e from m),
r as (select o_orderkey, match, len(e) as k, e[1] as first, regexp_extract(e[1], '([0-9]+)$', 1) as a, regexp_extract(e[2], '([0-9]+)$', 1) as b from s)
select o_orderkey, match, first as id from r where k = 1
union all select o_orderkey, match, 'AB' || lpad(cast(unnest(generate_series(cast(a as bigint), cast(a[1:length(a) - length(b)] || b as bigint))) as varchar), 4, '0') from r where k = 2 and a <= a[1:length(a) - length(b)] || b""")
def separate_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_TAG_TEXT).alias("text"))
    return expand.separate_tags(rows, "AB").select("o_orderkey", "match", "id")


@query("select doc_id, md5('v1' || coalesce(text, '')) as hash from documents")
def cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.cache_key(F.lit("v1"), F.col("text")).alias("hash"))


@query(f"""select doc_id, md5({_sql_replace('text', (rf'\b([a-zA-Z]){_B}*={_B}*([0-9.]+)', r'$\1 = \2$'), (rf'\b(p|P){_B}*[<>=]{_B}*([0-9.]+)', r'$\1 \\leq \2$'),
    (rf'\b(n|N){_B}*={_B}*([0-9,]+)', r'$n = \2$'), (r'([0-9.]+)%', r'$\1\\%$'), (r'([0-9.]+)/([0-9.]+)', r'$\\frac{\1}{\2}$'))}) as digest from documents""")
def math_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.md5(M.math_format(F.col("text"))).alias("digest"))


@query()
def species_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emphasis needs look-around, which the other engine's expressions lack."""
    text = M.species_emphasis(M.gene_emphasis(F.col("text")))
    return _documents(spark, sf_dir).filter(F.col("text") != text).select("doc_id", F.md5(text).alias("digest"))


@query("""select journal_abbrev, string_agg('# Article ' || i || '/' || n || chr(58) || chr(10) || chr(10) || pmc_id, chr(10) || chr(10) order by i) as context from
(select journal_abbrev, pmc_id, row_number() over (partition by journal_abbrev order by pmc_id) as i, count(*) over (partition by journal_abbrev) as n
 from (select distinct journal_abbrev, pmc_id from article_meta where journal_abbrev is not null and pmc_id is not null)) group by journal_abbrev""")
def context_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "article_meta").filter("journal_abbrev is not null and pmc_id is not null")
    return rows.groupBy("journal_abbrev").agg(T.join_articles(F.array_sort(F.collect_set("pmc_id"))).alias("context"))


@query(r"""select ref_key, case when regexp_full_match(year, '[0-9]+') then try_cast(year as int) end as year_int,
regexp_extract(coalesce(journal, 'x') || '/' || coalesce(pages, 'x') || '.json', '([^/]+)[.][^./]+$', 1) as stem from cited_ref""")
def scalar_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits to numbers, and file stems."""
    rows = table(spark, sf_dir, "cited_ref")
    path = F.concat(F.coalesce("journal", F.lit("x")), F.lit("/"), F.coalesce("pages", F.lit("x")), F.lit(".json"))
    return rows.select("ref_key", T.int_if_digits(F.col("year")).alias("year_int"), T.stem(path).alias("stem"))


@query(f"select doc_id from documents where case when {_sql_strip('text')} = '' or text is null then 0 else len(regexp_split_to_array({_sql_strip('text')}, '{_B}+')) end + 20 <= 300")
def length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(filters.within_budget(F.col("text"), 300, spare=20)).select("doc_id")


@query("""select doc_id from documents where contains(lower(text), 'autophagy') and contains(lower(text), 'liver') order by doc_id limit 50""")
def keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.budgeted_search(table(spark, sf_dir, "documents"), "text", ["Autophagy", "liver"], 50, "doc_id").select("doc_id")


# -- Licences, topics, statuses -----------------------------------------------------------------

_SQL_LICENSE = r"""case when coalesce(license_url, '') = '' then ''
when regexp_matches(lower(license_url), 'publicdomain/zero|creativecommons\.org/zero') then 'CC0 ' || case when regexp_extract(lower(license_url), 'zero/([0-9.]+)', 1) = '' then '1.0' else regexp_extract(lower(license_url), 'zero/([0-9.]+)', 1) end
when regexp_extract(lower(license_url), 'licenses/([a-z-]+)/([0-9.]+)', 1) <> '' then 'CC ' || upper(regexp_extract(lower(license_url), 'licenses/([a-z-]+)/([0-9.]+)', 1)) || ' ' || regexp_extract(lower(license_url), 'licenses/([a-z-]+)/([0-9.]+)', 2)
else lower(license_url) end"""


@query(f"select license_url, {_SQL_LICENSE} as code, count(*) as n from article_meta group by 1, 2")
def license_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "article_meta").withColumn("code", T.license_code(F.col("license_url")))
    return rows.groupBy("license_url", "code").agg(F.count("*").alias("n"))


@query("select pmc_id, loaded_at from article_meta where coalesce(license, '') <> '' and not contains(upper(license), 'BY-ND') and not contains(upper(license), 'BY ND')")
def license_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "article_meta").filter(filters.license_allowed(F.col("license"))).select("pmc_id", "loaded_at")


@query(r"select doc_id from documents where regexp_matches(lower(text), '\b(obesity|weight[\s\-]?loss|diabetes|diabetic)\b')")
def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(filters.on_topic(F.col("text"))).select("doc_id")


_TYPE = "case when month % 3 = 0 then 'review-article' when month % 3 = 1 then 'Research-Article' end"


@query(rf"""with s as (select journal_abbrev as archive, case when title is null then 'error'
when coalesce(license, '') <> '' and not contains(upper(license), 'BY-ND') and not contains(upper(license), 'BY ND') and lower(coalesce({_TYPE}, '')) = 'research-article'
 and regexp_matches(lower(title), '\b(obesity|weight[\s\-]?loss|diabetes|diabetic|gout)\b') then 'saved' else 'filtered' end as status from article_meta where journal_abbrev is not null)
select archive, status, count(*) as n from s group by archive, status union all select null, status, count(*) from s group by status""")
def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "article_meta").filter("journal_abbrev is not null")
    topic = filters.on_topic(F.col("title"), pattern=filters.TOPIC.replace("diabetic", "diabetic|gout"))
    error = F.when(F.col("title").isNull(), "no title")
    status = filters.ingest_status(F.col("license"), F.expr(_TYPE), topic, error)
    return relational.status_counts(rows.select(F.col("journal_abbrev").alias("archive"), status.alias("status")))


# -- Tables -------------------------------------------------------------------------------------


@query("""with t as (select distinct l_orderkey, 0 as n, 'Order ' || l_orderkey as c0, cast(null as varchar) as c1 from lineitem
union all select l_orderkey, l_linenumber * 10 + 1, l_returnflag, l_linestatus from lineitem)
select 'Order ' || l_orderkey as subheading, l_orderkey, n, c0, c1 from t where c1 is not null""")
def repeat_sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    heads = lines.select("l_orderkey").distinct().select("l_orderkey", F.lit(0).alias("n"), F.concat(F.lit("Order "), "l_orderkey").alias("c0"), F.lit(None).cast("string").alias("c1"))
    rows = lines.select("l_orderkey", (F.col("l_linenumber") * 10 + 1).alias("n"), F.col("l_returnflag").alias("c0"), F.col("l_linestatus").alias("c1"))
    return reshape.repeat_sub(heads.unionByName(rows), "l_orderkey", "n", ["c0", "c1"])


@query("""with h as (select distinct l_orderkey from lineitem),
t as (select l_orderkey, l_linenumber * 10 + 1 as n, l_returnflag as c0, l_linestatus as c1, case when l_orderkey % 7 = 0 then null when l_orderkey % 3 = 0 then 'Again ' || l_orderkey else 'Order ' || l_orderkey end as subheading from lineitem
union all select l_orderkey, k, case k when 0 then 'Order ' when 1 then 'Again ' else 'Thrice ' end || l_orderkey, null, null from h, unnest([0, 1, 2]) as u(k) where l_orderkey % 7 = 0)
select distinct subheading, l_orderkey, n, c0, c1 from t""")
def repeat_sub_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two subheadings in a row the second counts; a table with more than one such pair stays as it is."""
    lines = table(spark, sf_dir, "lineitem")
    name = F.element_at(F.array(F.lit("Order "), F.lit("Again "), F.lit("Thrice ")), F.col("n") + 1)
    wanted = F.when(F.col("l_orderkey") % 7 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).when(F.col("l_orderkey") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    heads = lines.select("l_orderkey").distinct().withColumn("n", F.explode(wanted)).select("l_orderkey", "n", F.concat(name, "l_orderkey").alias("c0"), F.lit(None).cast("string").alias("c1"))
    rows = lines.select("l_orderkey", (F.col("l_linenumber") * 10 + 1).alias("n"), F.col("l_returnflag").alias("c0"), F.col("l_linestatus").alias("c1"))
    return reshape.repeat_sub(heads.unionByName(rows), "l_orderkey", "n", ["c0", "c1"]).distinct()


@query("""select journal_abbrev as "table", cast(row_number() over (partition by journal_abbrev order by pmc_id, loaded_at) as int) as row, concat_ws('; ', 'title=' || nullif(nullif(title, ''), chr(160)), 'year=' || year, 'journal=' || nullif(nullif(journal, ''), chr(160)), 'license=' || nullif(nullif(license, ''), chr(160))) as text from article_meta
where coalesce(title, cast(year as varchar), journal, license, '') <> ''""")
def collapse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    meta = table(spark, sf_dir, "article_meta").filter("coalesce(title, cast(year as string), journal, license, '') <> ''")
    rows = meta.withColumn("row", F.row_number().over(Window.partitionBy("journal_abbrev").orderBy("pmc_id", "loaded_at")))
    return reshape.collapse_rows(rows, "journal_abbrev", "row", ["title", "year", "journal", "license"])


@query("""select s_suppkey, r_name || '; ' || n_name || '; ' || s_name as path from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def path_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    levels = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.col(c).alias("name")) for i, c in enumerate(("r_name", "n_name", "s_name"), 3)]))
    rows = flat.select("s_suppkey", levels.alias("x")).select("s_suppkey", "x.level", "x.name")
    return reshape.path_string(rows, "s_suppkey", "level", "name", "level")


@query("""with e as (select user_id, ts, event_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as before, row_number() over (partition by user_id order by ts, event_id) as n from events),
i as (select *, sum(case when n = 1 or event_type is distinct from before then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) as island from e)
select user_id, cast(island as int) as island, min(event_type) as event_type, count(*) as n, string_agg(cast(event_id as varchar), ' ' order by ts, event_id) as ids from i group by user_id, island""")
def paragraph_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    marked = relational.islands(rows, "user_id", "at", "event_type").withColumn("id", F.col("event_id").cast("string"))
    joined = relational.joined_text(marked, ["user_id", "island"], "at", "id", " ").withColumnRenamed("id", "ids")
    counts = marked.groupBy("user_id", "island").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"))
    return counts.join(joined, ["user_id", "island"]).select("user_id", "island", "event_type", "n", "ids")


@query("""select r_name, '**' || r_name || '**' || chr(10) || chr(10) || '| key | nation |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_nationkey || ' | ' || n_name || ' |', chr(10) order by n_nationkey) as markdown
from nation join region on n_regionkey = r_regionkey group by r_name""")
def table_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    some = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    grids = rows.groupBy("r_name").agg(F.transform(some, lambda x: F.array(x["n_nationkey"].cast("string"), x["n_name"])).alias("rows"))
    return grids.select("r_name", M.table_markdown(F.col("r_name"), F.array(F.lit("key"), F.lit("nation")), F.col("rows")).alias("markdown"))


@query("""select ref_key, id || '. ' || concat_ws('. ', nullif(authors, ''), '**' || nullif(title, '') || '**', nullif(concat_ws(' ', '*' || nullif(journal, '') || '*', '(' || nullif(year, '') || ')', '**' || nullif(volume, '') || '**', nullif(pages, '')), ''),
coalesce('DOI: ' || nullif(doi, ''), 'PMID: ' || nullif(pmid, ''))) as line from cited_ref""")
def reference_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.col(c) for c in ("id", "authors", "title", "journal", "year", "volume", "pages", "doi", "pmid")]
    return table(spark, sf_dir, "cited_ref").select("ref_key", M.reference_line(*parts).alias("line"))


@query()
def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = M.front_matter(*[F.col(c) for c in ("title", "authors", "journal", "year", "pmc_id", "doi", "license")])
    return table(spark, sf_dir, "article_meta").select("pmc_id", "loaded_at", head.alias("head"))


# -- Articles in XML ----------------------------------------------------------------------------


def _escaped(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(mark), F.lit(name))
    return text


def _element(name: str, inner: Column, attributes: str = "") -> Column:
    return F.when(inner.isNotNull(), F.concat(F.lit(f"<{name}{attributes}>"), _escaped(inner), F.lit(f"</{name}>"))).otherwise("")


def _article_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pmc_id, loaded_at, xml)``: the metadata table as articles."""
    meta = table(spark, sf_dir, "article_meta")
    person = lambda a: F.concat(
        F.lit('<contrib contrib-type="author"><name>'), _element("surname", F.regexp_extract(a, r"(\S+)$", 1)), _element("given-names", F.regexp_extract(a, r"^(.*\S)\s+\S+$", 1)), F.lit("</name></contrib>")
    )
    people = F.concat(F.lit("<contrib-group>"), F.array_join(F.transform(F.coalesce("authors", F.array().cast("array<string>")), person), ""), F.lit("</contrib-group>"))
    licence = F.when(F.col("license_url").isNotNull(), F.concat(F.lit('<permissions><license xlink:href="'), _escaped(F.col("license_url")), F.lit('"/></permissions>'))).otherwise("")
    front = F.concat(
        F.lit('<article xmlns:xlink="http://www.w3.org/1999/xlink" article-type="research-article"><front><journal-meta>'),
        _element("journal-id", F.col("journal_abbrev"), ' journal-id-type="nlm-ta"'), _element("journal-title", F.col("journal")), _element("issn", F.col("issn"), ' pub-type="epub"'),
        F.lit("</journal-meta><article-meta>"),
        _element("article-id", F.col("pmc_id"), ' pub-id-type="pmc"'), _element("article-id", F.col("pmid"), ' pub-id-type="pmid"'), _element("article-id", F.col("doi"), ' pub-id-type="doi"'),
        F.lit("<title-group>"), _element("article-title", F.col("title")), F.lit("</title-group>"), people,
        F.lit('<pub-date pub-type="epub">'), _element("day", F.col("day").cast("string")), _element("month", F.col("month").cast("string")), _element("year", F.col("year").cast("string")), F.lit("</pub-date>"),
        licence, F.lit("</article-meta></front>"),
    )
    body = F.concat(
        F.lit("<body><p>Opening remark. It has two sentences.</p><sec><title>Methods</title><p>"), _escaped(F.col("journal")),
        F.lit('</p><fig><label>Figure 1</label><caption>A curve</caption></fig><table-wrap><label>Table 1</label><table><tr><th>year</th><th>month</th></tr><tr><td>'),
        F.coalesce(F.col("year").cast("string"), F.lit("")), F.lit("</td><td>"), F.coalesce(F.col("month").cast("string"), F.lit("")),
        F.lit('</td></tr></table></table-wrap></sec></body><back><ref-list><ref><surname>Bell</surname><given-names>A</given-names><article-title>'),
        _escaped(F.col("title")), F.lit("</article-title><year>"), F.coalesce(F.col("year").cast("string"), F.lit("")), F.lit("</year></ref></ref-list></back></article>"),
    )
    return meta.select("pmc_id", "loaded_at", F.concat(front, body).alias("xml"))


@query("select pmc_id, loaded_at, n from article_meta, unnest([0, 1]) as t(n)")
def article_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.concat(F.lit("<set>"), F.col("xml"), F.lit("\n<ARTICLE id='2'>second\n</ARTICLE></set>"))
    rows = _article_xml(spark, sf_dir).select("pmc_id", "loaded_at", F.posexplode(jats.split_articles(payload)).alias("n", "article"))
    return rows.select("pmc_id", "loaded_at", "n")


@query(rf"""select pmc_id, loaded_at, pmid, doi, nullif({_sql_strip('title')}, '') as title, array_to_string(list_filter(authors, lambda a: regexp_matches(a, '^.*\S\s+\S+$')), '|') as authors, year, month, day, license_url,
case when license_url is not null then {_SQL_LICENSE} end as license, journal, journal_abbrev, issn from article_meta""")
def xml_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = jats.metadata(jats.parse_articles(_article_xml(spark, sf_dir), "xml"), "loaded_at")
    return meta.withColumn("authors", F.array_join("authors", "|"))


@query("""select pmc_id, loaded_at, x.pos as pos, x.s as section, x.p as paragraph, x.n as sentence, case when x.t = 'J' then coalesce(journal, '') else x.t end as text from article_meta, unnest([
{'pos': 1, 's': 'Body', 'p': 1, 'n': 1, 't': 'Opening remark.'}, {'pos': 1, 's': 'Body', 'p': 1, 'n': 2, 't': 'It has two sentences.'}, {'pos': 2, 's': 'Methods', 'p': 1, 'n': 1, 't': 'J'},
{'pos': case when journal is null then 2 else 3 end, 's': 'Methods', 'p': 0, 'n': 0, 't': '**Figure 1:** *A curve*'}, {'pos': case when journal is null then 3 else 4 end, 's': 'Methods', 'p': 0, 'n': 0, 't': 'TABLE_PLACEHOLDER:Table 1'}]) as u(x)
where not (x.t = 'J' and journal is null)""")
def xml_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jats.text_rows(jats.parse_articles(_article_xml(spark, sf_dir), "xml"), "pmc_id", "loaded_at")


@query("""select pmc_id, loaded_at, 'Table 1' as label, case when year is not null and month is not null then 'year|month' when year is not null then 'year' when month is not null then 'month' else '' end as header,
concat_ws('|', cast(year as varchar), cast(month as varchar)) as cells from article_meta""")
def xml_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jats.table_rows(jats.parse_articles(_article_xml(spark, sf_dir), "xml"), "pmc_id", "loaded_at")
    return rows.select("pmc_id", "loaded_at", "label", F.array_join("header", "|").alias("header"), F.array_join(F.flatten("rows"), "|").alias("cells"))


@query(rf"""select pmc_id, loaded_at, 1 as id, 'Bell A' as authors, cast(year as varchar) as year, nullif(regexp_replace({_sql_strip('title')}, '\n\s*', ' ', 'g'), '') as title from article_meta""")
def xml_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jats.reference_rows(jats.parse_articles(_article_xml(spark, sf_dir), "xml"), "pmc_id", "loaded_at")
    return rows.select("pmc_id", "loaded_at", "id", "authors", "year", "title")


@query()
def xml_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_markdown(jats.parse_articles(_article_xml(spark, sf_dir), "xml"))
    return rows.select("pmc_id", "loaded_at", "markdown")


@query(f"""with s as (select right(pmc_id, 1) as archive, case when coalesce(pmc_id like '%7', false) then 'error'
when license_url is not null and {_SQL_LICENSE} <> '' and not contains(upper({_SQL_LICENSE}), 'BY-ND') and not contains(upper({_SQL_LICENSE}), 'BY ND') then 'saved' else 'filtered' end as status from article_meta)
select archive, status, count(*) as n from s group by archive, status union all select null, status, count(*) from s group by status""")
def xml_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of parsed articles, those that are cut off included."""
    rows = _article_xml(spark, sf_dir).withColumn("content", F.when(F.col("pmc_id").endswith("7"), F.expr("left(xml, 200)")).otherwise(F.col("xml")))
    marked = with_status(rows.withColumn("archive", F.right("pmc_id", F.lit(1))), topic=None)
    return relational.status_counts(marked)


_SHAPES = (
    '<?xml version="1.0"?><!DOCTYPE article PUBLIC "x" "y.dtd"><article xmlns="http://jats.nlm.nih.gov" xmlns:ali="http://www.niso.org/schemas/ali/1.0/" xmlns:xlink="http://www.w3.org/1999/xlink" article-type="Research-Article">'
    '<front><article-meta><article-id pub-id-type="pmc">PMC{key}</article-id><title-group><article-title>On <italic>{name}</italic>, again</article-title></title-group>'
    '<contrib-group><contrib contrib-type="author"><name><surname>Bell</surname></name></contrib><contrib contrib-type="author"><name><surname>Ray</surname><given-names>C D</given-names></name></contrib>'
    '<contrib contrib-type="editor"><name><surname>Ito</surname><given-names>E</given-names></name></contrib></contrib-group><contrib-group><contrib contrib-type="author"><name><surname>Orr</surname><given-names>F</given-names></name></contrib></contrib-group>'
    '<pub-date pub-type="ppub"><year>1999</year></pub-date><pub-date pub-type="epub"><year>2001</year><month>May</month><day>7</day></pub-date>'
    '<permissions>{licence}</permissions><abstract><p>Short word on {name}.</p><sec><title>Aim</title><p>To see. To know.</p></sec></abstract></article-meta></front>'
    '<body><p> </p><p>Open words.</p><sec><title>Methods</title><!-- note --><sec><title>Design</title><p>A design.</p></sec><sec><p>Untitled part.</p></sec><fig><label>Figure 2</label></fig><fig><label>Figure 3</label><caption><p>A {name} curve</p></caption></fig>'
    '<table-wrap><label>Table 1</label><table><tr><th>old</th></tr><tr><td>1</td></tr></table></table-wrap>'
    '<table-wrap><label>Table 2</label><caption>Both</caption><table><tr><th colspan="2">a</th><th>b</th></tr><tr><td rowspan="2">{name}</td><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr><tr><td/><td/><td/></tr></table></table-wrap>'
    '<table-wrap><table><tr><th>c</th><th/></tr><tr><td>5</td><td>6</td></tr></table></table-wrap>'
    '<table-wrap><label>Table 1</label><table><tr><th>new</th><th>none</th></tr><tr><td>{key}</td><td> </td></tr></table></table-wrap></sec></body>'
    '<back><ref-list><ref><element-citation><name><surname>Lin</surname></name><name><surname>Poe</surname></name><article-title>First</article-title><fpage>7</fpage><lpage>9</lpage><pub-id pub-id-type="doi">10.1/{key}</pub-id></element-citation></ref>'
    '<ref><mixed-citation>A   whole {name} text, 1987.</mixed-citation></ref><ref><element-citation><name><surname>Bo</surname><given-names>G</given-names></name><year>2003</year><source>J</source><volume>4</volume><fpage>11</fpage></element-citation></ref></ref-list></back></article>'
)
_LICENCES = (
    '<license xlink:href="https://creativecommons.org/licenses/by/4.0/"/>', '<license><ali:license_ref>https://creativecommons.org/licenses/by-nc/4.0/</ali:license_ref></license>',
    '<ali:license_ref>http://creativecommons.org/publicdomain/zero/1.0/</ali:license_ref>', '<license><license-p>See <ext-link xlink:href="https://creativecommons.org/licenses/by-nd/3.0/">it</ext-link></license-p></license>',
    '<license-p>Open: <uri xlink:href="https://creativecommons.org/licenses/by/2.0/">by</uri></license-p>', "",
)


def _shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(s_suppkey, doc)``: an article of every branch of the parser for each supplier, the licence at one of five places or at none."""
    text = F.lit(_SHAPES)
    licence = F.element_at(F.array(*map(F.lit, _LICENCES)), F.pmod("s_suppkey", F.lit(len(_LICENCES))).cast("int") + 1)
    for mark, value in (("{licence}", licence), ("{key}", F.col("s_suppkey").cast("string")), ("{name}", F.col("s_name"))):
        text = F.replace(text, F.lit(mark), value)
    return jats.parse_articles(table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("xml")), "xml")


@query("""select s_suppkey, 'PMC' || s_suppkey as pmc_id, 'On ' || s_name || ', again' as title, 'C D Ray' as authors, 2001 as year, cast(null as int) as month, 7 as day,
case s_suppkey % 6 when 0 then 'CC BY 4.0' when 1 then 'CC BY-NC 4.0' when 2 then 'CC0 1.0' when 3 then 'CC BY-ND 3.0' when 4 then 'CC BY 2.0' end as license from supplier""")
def xml_shapes_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jats.metadata(_shapes(spark, sf_dir), "s_suppkey")
    return rows.select("s_suppkey", "pmc_id", "title", F.array_join("authors", "|").alias("authors"), "year", "month", "day", "license")


@query("""select s_suppkey, x.pos as pos, x.s as section, x.p as paragraph, x.n as sentence, replace(x.t, '@', s_name) as text from supplier, unnest([
{'pos': 1, 's': 'Body', 'p': 2, 'n': 1, 't': 'Open words.'}, {'pos': 2, 's': 'Abstract', 'p': 0, 'n': 0, 't': ''}, {'pos': 3, 's': 'Abstract', 'p': 1, 'n': 1, 't': 'Short word on @.'},
{'pos': 4, 's': 'Abstract; Aim', 'p': 1, 'n': 1, 't': 'To see.'}, {'pos': 4, 's': 'Abstract; Aim', 'p': 1, 'n': 2, 't': 'To know.'}, {'pos': 5, 's': 'Methods', 'p': 0, 'n': 0, 't': '**Figure 3:** *A @ curve*'},
{'pos': 6, 's': 'Methods', 'p': 0, 'n': 0, 't': 'TABLE_PLACEHOLDER:Table 1'}, {'pos': 7, 's': 'Methods', 'p': 0, 'n': 0, 't': 'TABLE_PLACEHOLDER:Table 2'}, {'pos': 8, 's': 'Methods', 'p': 0, 'n': 0, 't': 'TABLE_PLACEHOLDER:Table 1'},
{'pos': 9, 's': 'Design', 'p': 1, 'n': 1, 't': 'A design.'}, {'pos': 10, 's': 'Methods', 'p': 1, 'n': 1, 't': 'Untitled part.'}]) as u(x)""")
def xml_shapes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jats.text_rows(_shapes(spark, sf_dir), "s_suppkey")


@query("""select s_suppkey, x.pos as pos, x.l as label, x.c as caption, x.h as header, replace(replace(x.r, '@', s_name), '^', cast(s_suppkey as varchar)) as cells from supplier, unnest([
{'pos': 1, 'l': 'Table 1', 'c': null, 'h': 'new', 'r': '^'}, {'pos': 2, 'l': 'Table 2', 'c': 'Both', 'h': 'a|a.1|b', 'r': '@|1|2/@|3|4'}, {'pos': 3, 'l': 'Table 3', 'c': null, 'h': 'c|Unnamed: 1', 'r': '5|6'}]) as u(x)""")
def xml_shapes_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jats.table_rows(_shapes(spark, sf_dir), "s_suppkey")
    cells = F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "/")
    return rows.select("s_suppkey", "pos", "label", "caption", F.array_join("header", "|").alias("header"), cells.alias("cells"))


@query("""select s_suppkey, x.id as id, replace(x.a, '@', s_name) as authors, x.y as year, x.t as title, x.j as journal, x.v as volume, x.p as pages, x.d || s_suppkey as doi from supplier, unnest([
{'id': 1, 'a': 'Lin, Poe', 'y': null, 't': 'First', 'j': null, 'v': null, 'p': '7-9', 'd': '10.1/'}, {'id': 2, 'a': 'A whole @ text, 1987.', 'y': null, 't': null, 'j': null, 'v': null, 'p': null, 'd': null},
{'id': 3, 'a': 'Bo G', 'y': '2003', 't': null, 'j': 'J', 'v': '4', 'p': '11', 'd': null}]) as u(x)""")
def xml_shapes_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jats.reference_rows(_shapes(spark, sf_dir), "s_suppkey").drop("pmid")


@query(r"""select s_suppkey, replace(replace(replace('## Body

Open words.

## Abstract

Short word on @.

### Aim

To see. To know.

## Methods

**Figure 3:** *A @ curve*

~**Table 2**

| a | a.1 | b |
| --- | --- | --- |
| @ | 1 | 2 |
| @ | 3 | 4 |

~Untitled part.

## Design

A design.

## References

1. Lin, Poe. **First**. 7-9. DOI: 10.1/^

2. A whole @ text, 1987.

3. Bo G. *J* (2003) **4** 11', '~', '**Table 1**

| new |
| --- |
| ^ |

'), '@', s_name), '^', cast(s_suppkey as varchar)) as markdown from supplier""")
def xml_shapes_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections in the order of their first mention, figures and tables in place, and the reference list; no front matter."""
    return to_markdown(_shapes(spark, sf_dir), include_metadata=False).select("s_suppkey", "markdown")


@query("""select tag, cast(sum(n) as bigint) as n from (select unnest([{'t': 'ref', 'n': 1}, {'t': 'fig', 'n': 1}, {'t': 'td', 'n': 2}, {'t': 'sec', 'n': 1}]) as x from article_meta) as q, lateral (select x.t as tag, x.n as n) group by tag""")
def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jats.tag_counts(_article_xml(spark, sf_dir), "xml").filter(F.col("tag").isin("ref", "fig", "td", "sec"))


@query("select distinct lower(replace(replace(journal_abbrev, '.', ''), ' ', '-')) || '.tar.gz' as name from article_meta where journal_abbrev is not null order by name offset 3")
def link_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.lower(F.replace(F.replace("journal_abbrev", F.lit("."), F.lit("")), F.lit(" "), F.lit("-")))
    pages = table(spark, sf_dir, "article_meta").filter("journal_abbrev is not null").select(F.concat(F.lit('<a href="index.html">up</a><A HREF="'), name, F.lit('.tar.gz">x</A>')).alias("html"))
    return listing.list_archives(pages, "html", skip=3)


# -- Caches and records -------------------------------------------------------------------------


@query("select hash, max_by(response.qa.question, (cached_at, qa_id)) as question from qa_cache where qa_id % 7 <> 0 group by hash")
def jsonl_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache as JSON lines of which some are cut off; the last of a key counts."""
    from pyspark.sql.types import StructField, StructType

    rows = table(spark, sf_dir, "qa_cache")
    line = F.to_json(F.struct("hash", "response"))
    lines = rows.select(F.struct("cached_at", "qa_id").alias("pos"), F.when(F.col("qa_id") % 7 == 0, F.expr("left(to_json(struct(hash, response)), 40)")).otherwise(line).alias("value"))
    schema = StructType([StructField("hash", rows.schema["hash"].dataType), StructField("response", RECORD)])
    return jsonl.parse_cache(lines, schema).select("hash", F.col("response.qa.question").alias("question"))


@query("""with c as (select distinct md5(coalesce(text, '')) as hash, length(text) as size from documents where doc_id % 2 = 0 and text is not null)
select d.doc_id, length(d.text) as size, c.hash is not null as cached from documents d left join c on md5(d.text) = c.hash where d.text is not null""")
def cache_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", "text", T.cache_key(F.col("text")).alias("hash"))
    cache = docs.filter("doc_id % 2 = 0").dropDuplicates(["hash"]).select("hash", F.length("text").cast("bigint").alias("size"))
    rows, new = relational.through_cache(docs, "hash", cache, "size", lambda missing: missing.select("hash", F.length("text").cast("bigint").alias("size")))
    return rows.join(new.select("hash", F.lit(True).alias("new")), "hash", "left").select("doc_id", "size", F.col("new").isNull().alias("cached"))


_SQL_ACCEPTED = """response.qa is not null and response.rubric is not null and response.judge_with_context is not null and response.judge_without_context is not null
and response.judge_with_context.correct = 'yes' and response.judge_without_context.correct = 'no' and response.rubric.askability >= 4 and response.rubric.synthesizability >= 4 and response.rubric.abstractiveness >= 4 and response.rubric.conflict_synthesis >= 4"""


@query(f"select qa_id, response.rubric.difficulty as difficulty from qa_cache where {_SQL_ACCEPTED} and response.rubric.difficulty in ('graduate', 'phd')")
def qa_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "qa_cache").filter(filters.accepted("response")).select("qa_id", F.col("response.rubric.difficulty").alias("difficulty"))


@query(f"""with g as (select qa_id, response.qa.question as question, response.qa.answer as answer, case when response.rubric.difficulty = 'phd' then 'test' else 'train' end as split from qa_cache
where {_SQL_ACCEPTED} and response.rubric.difficulty in ('graduate', 'phd')),
r as (select *, row_number() over (partition by concat_ws(chr(1), question, answer) order by qa_id) as n from g) select qa_id, question, answer, split from r where n = 1""")
def qa_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_plan.split(table(spark, sf_dir, "qa_cache"), "qa_id")


@query("""select qa_id, (response.qa is null or coalesce(response.qa.question is not null and response.qa.answer is not null and response.qa.strict, false))
and (response.rubric is null or coalesce(response.rubric.difficulty in ('high school', 'graduate', 'phd') and response.rubric.strict and response.rubric.askability between 0 and 5 and response.rubric.synthesizability between 0 and 5
 and response.rubric.abstractiveness between 0 and 5 and response.rubric.conflict_synthesis between 0 and 5, false))
and (response.judge_with_context is null or coalesce(response.judge_with_context.correct in ('yes', 'no') and response.judge_with_context.strict, false))
and (response.judge_without_context is null or coalesce(response.judge_without_context.correct in ('yes', 'no') and response.judge_without_context.strict, false)) as valid from qa_cache""")
def record_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "qa_cache").select("qa_id", filters.valid_record("response").alias("valid"))


@query("""select round(count(*) filter (where response.judge_with_context.correct = 'yes') / count(*), 9) as accuracy, count(*) filter (where response.judge_with_context.correct = 'yes') as correct,
count(*) filter (where coalesce(response.judge_with_context.correct, '') <> 'yes') as incorrect from qa_cache where response.qa is not null""")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = table(spark, sf_dir, "qa_cache").filter("response.qa is not null").select(F.col("response.judge_with_context.correct").alias("correct"))
    return relational.accuracy(judged).withColumn("accuracy", F.round("accuracy", 9))


_SQL_TITLES = """(select journal_abbrev, string_agg('# Article ' || i || '/' || n || chr(58) || chr(10) || chr(10) || title, chr(10) || chr(10) order by i) as context from
(select journal_abbrev, title, row_number() over (partition by journal_abbrev order by title) as i, count(*) over (partition by journal_abbrev) as n
 from (select distinct journal_abbrev, title from article_meta where journal_abbrev is not null and title is not null)) group by journal_abbrev)"""


@query(f"""with q as (select journal_abbrev, 'What links the articles ' || md5(context)[1:6] || '?' as question from {_SQL_TITLES})
select journal_abbrev, question, case (instr('0123456789abcdef', md5(question)[2:2]) - 1) % 3 when 0 then 'high school' when 1 then 'graduate' else 'phd' end as difficulty from q""")
def qa_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs from groups of articles by the stand-in model, through an empty cache."""
    groups = table(spark, sf_dir, "article_meta").filter("journal_abbrev is not null and title is not null").groupBy("journal_abbrev").agg(F.array_sort(F.collect_set("title")).alias("texts"))
    cache = spark.createDataFrame([], "hash string").withColumn("response", F.from_json(F.lit(None).cast("string"), RECORD))
    rows, _ = qa_plan.build(groups, "journal_abbrev", "texts", cache, ScriptedModel())
    return rows.select("journal_abbrev", "response.qa.question", "response.rubric.difficulty")


@query("""select item_id, md5('Question: ' || question || chr(10) || 'Answer (' || split || '): ' || answer || '.') as prompt,
md5('["' || replace(replace(question, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '"]') as key from qa_test""")
def prompt_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts from a template, and the cache key of a list of texts as JSON."""
    rows = table(spark, sf_dir, "qa_test")
    prompt = T.fill("Question: {}\nAnswer ({}): {}.", F.col("question"), F.col("split"), F.col("answer"))
    return rows.select("item_id", F.md5(prompt).alias("prompt"), T.cache_key(F.to_json(F.array("question"))).alias("key"))


@query("select item_id, 'no' as correct from qa_test")
def qa_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in model judged on the held-out pairs."""
    cache = spark.createDataFrame([], "hash string, correct string")
    judged, _, _ = qa_plan.evaluate(table(spark, sf_dir, "qa_test"), "item_id", cache, ScriptedModel(), ScriptedModel())
    return judged.select("item_id", "correct")


@query("select min(doc_id) as doc_id from documents where text is not null group by text union all select doc_id from documents where text is null")
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.first_per_value(table(spark, sf_dir, "documents"), F.col("text"), "doc_id").select("doc_id")


@query("select event_type, user_id, cast(rank as int) as rank from (select event_type, user_id, row_number() over (partition by event_type order by n desc, user_id) as rank from (select event_type, user_id, count(*) as n from events group by 1, 2)) where rank <= 3")
def top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return relational.top_k(counts, "event_type", 3, F.desc("n"), F.col("user_id")).select("event_type", "user_id", "rank")


@query("select time_bucket(interval 1 hour, ts) as start, event_type, count(*) as n from events group by 1, 2")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type")


# -- Vectors ------------------------------------------------------------------------------------


@query("""with n as (select vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: cast(x as double) * x))) as l from embeddings)
select vec_id, cast(i as int) as i, round(cast(x as double) / l, 5) + 0.0 as value from (select vec_id, l, unnest(embedding) as x, generate_subscripts(embedding, 1) - 1 as i from n)""")
def normalize_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(V.normalize(F.col("embedding"))).alias("i", "x"))
    return rows.select("vec_id", "i", (F.round("x", 5) + F.lit(0.0)).alias("value"))


@query("""select a.vec_id as a, b.vec_id as b, round(list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])), 5) + 0.0 as sim from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""")
def pair_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    a, b = e.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x")), e.select((F.col("vec_id") - 1).alias("a"), F.col("vec_id").alias("b"), F.col("embedding").alias("y"))
    return a.join(b, "a").select("a", "b", (F.round(V.cosine(F.col("x"), F.col("y")), 5) + F.lit(0.0)).alias("sim"))


_SQL_KNN = """s as (select a.vec_id as src, b.vec_id as dst, list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])) as sim from embeddings a join embeddings b on a.vec_id <> b.vec_id),
k as (select *, row_number() over (partition by src order by sim desc, dst) as rank from s qualify rank <= 5)"""


@query(f"with {_SQL_KNN} select src, dst, cast(rank as int) as rank, round(sim, 4) + 0.0 as sim from k")
def knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = cliques.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 5)
    return near.select("src", "dst", "rank", (F.round("sim", 4) + F.lit(0.0)).alias("sim"))


@query("""with s as (select a.vec_id as src, b.vec_id as dst, list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])) as sim from embeddings a join embeddings b on a.vec_id <> b.vec_id),
k as (select *, row_number() over (partition by src order by sim desc, dst) as rank from s qualify rank <= 2),
m as (select src as seed, src as id from k union select src, dst from k),
p as (select x.seed, min(s.sim) as low, avg(s.sim) as mean from m x join m y on x.seed = y.seed and x.id < y.id join s on s.src = x.id and s.dst = y.id group by x.seed)
select seed, round(mean, 4) as mean_sim from p where low >= 0.05""")
def clique_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    near = cliques.nearest(vectors, "vec_id", "embedding", 2)
    found = cliques.candidates(vectors, "vec_id", "embedding", near, 2, 0.05)
    return found.select("seed", F.round("mean_sim", 4).alias("mean_sim"))


@query("""with recursive s as (select a.vec_id as src, b.vec_id as dst, list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])) as sim from embeddings a join embeddings b on a.vec_id <> b.vec_id),
k as (select *, row_number() over (partition by src order by sim desc, dst) as rank from s qualify rank <= 2),
m as (select src as seed, src as id, 0 as rank from k union select src, dst, rank from k),
p as (select x.seed, min(s.sim) as low from m x join m y on x.seed = y.seed and x.id < y.id join s on s.src = x.id and s.dst = y.id group by x.seed),
c as (select p.seed, max(k.sim) as sim1 from p join k on k.src = p.seed where low >= 0.05 group by p.seed),
o as (select c.seed, list(m.id order by m.rank) as members, row_number() over (order by c.sim1 desc, c.seed) as n from c join m on m.seed = c.seed group by c.seed, c.sim1),
r as (select 0::bigint as n, []::bigint[] as used, []::bigint[] as seeds union all
 select r.n + 1, case when len(list_intersect(r.used, o.members)) > 0 then r.used else list_concat(r.used, o.members) end,
  case when len(list_intersect(r.used, o.members)) > 0 then r.seeds else list_append(r.seeds, o.seed) end from r join o on o.n = r.n + 1)
select seed, array_to_string(members, ' ') as members from o where list_contains((select seeds from r order by n desc limit 1), seed)""")
def clique_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A greedy choice of disjoint groups."""
    vectors = table(spark, sf_dir, "embeddings")
    near = cliques.nearest(vectors, "vec_id", "embedding", 2)
    return cliques.pack(cliques.candidates(vectors, "vec_id", "embedding", near, 2, 0.05)).select("seed", F.array_join(F.transform("members", lambda x: x.cast("string")), " ").alias("members"))


@query("""with recursive u as (select vec_id, embedding, row_number() over (order by vec_id) as n from embeddings),
s as (select a.vec_id as a, b.vec_id as b from embeddings a join embeddings b on a.vec_id < b.vec_id and list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])) >= 0.55),
r as (select 0 as n, []::bigint[] as kept union all
 select r.n + 1, case when len(list_intersect(r.kept, coalesce((select list(a) from s where b = u.vec_id), []))) > 0 then r.kept else list_append(r.kept, u.vec_id) end from r join u on u.n = r.n + 1)
select e.vec_id, list_contains((select kept from r order by n desc limit 1), e.vec_id) as kept from embeddings e""")
def dedup_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return cliques.keep_first(vectors, cliques.similar(vectors, "vec_id", "embedding", 0.55), "vec_id")


@query(f"""select doc_id, md5('hashed-words-1' || chr(10) || text) as hash from documents
where text is not null and case when {_sql_strip('text')} = '' then 0 else len(regexp_split_to_array({_sql_strip('text')}, '{_B}+')) end <= 32768""")
def embed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents embedded by the stand-in through a cache of half of them."""
    docs = table(spark, sf_dir, "documents")
    cache = spark.createDataFrame([], "hash string, embedding array<float>")
    _, half = embed_plan.embed(docs.filter("doc_id % 2 = 0"), "text", cache, HashEmbedder())
    rows, _ = embed_plan.embed(docs, "text", half, HashEmbedder())
    return rows.select("doc_id", "hash")


@query()
def embed_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of close texts of the pages, near-duplicates out first, with the defaults of the plan."""
    finite = F.forall("embed", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embed", lambda x: x != 0)
    rows = table(spark, sf_dir, "dataset").filter(F.col("embed").isNotNull() & (F.size("embed") == 128) & finite)
    found = embed_plan.cluster(rows, "row_id", "text", "embed")
    return found.select("seed", F.size("texts").alias("size"), F.round(F.col("avg_similarity").cast("double"), 3).alias("avg_similarity"))


# -- Concepts -----------------------------------------------------------------------------------

_TERMS = {"liver": ("C01", 0.9), "kidney cortex": ("C02", 0.8), "kidney": ("C03", 0.95), "spleen": ("C04", 0.71), "retina": ("C05", 0.6)}
_SQL_TERMS = ", ".join(f"('{t}', '{c}', {s})" for t, (c, s) in _TERMS.items())
_SQL_MENTIONS = f"""a(alias, concept, score) as (values {_SQL_TERMS}),
w as (select doc_id, unnest(regexp_extract_all(lower(text), '\\b(?:kidney cortex|kidney|liver|spleen|retina)\\b', 0)) as mention from documents where text is not null)"""


@query(f"with {_SQL_MENTIONS} select doc_id, mention, concept, count(*) as n from w join a on alias = mention where score >= 0.7 group by all")
def concept_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = _linked(spark, sf_dir)
    return linked.groupBy("doc_id", "mention", "concept").agg(F.count("*").alias("n"))


@query(f"""with {_SQL_MENTIONS}, l as (select doc_id, regexp_extract_all(lower(text), '\\b(?:kidney cortex|kidney|liver|spleen|retina)\\b', 0) as m from documents where text is not null),
o as (select doc_id, unnest(m) as mention, generate_subscripts(m, 1) as i from l)
select doc_id, string_agg(concept, ' ' order by i) as concepts from o join a on alias = mention where score >= 0.7 group by doc_id""")
def doc_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concepts.concepts_of(_linked(spark, sf_dir), "doc_id").select("doc_id", F.array_join("concepts", " ").alias("concepts"))


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = concepts.mentions(table(spark, sf_dir, "documents"), list(_TERMS), "doc_id")
    aliases = spark.createDataFrame([(t, c, s) for t, (c, s) in _TERMS.items()], "alias string, concept string, score double")
    return concepts.link(found, aliases, "doc_id")


# -- Dealt problems of the core -----------------------------------------------------------------


@query()
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.citation_values(table(spark, sf_dir, "article_raw"))


@query()
def p3_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.article_table(table(spark, sf_dir, "article_raw"))


@query()
def p3_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.citation_table(table(spark, sf_dir, "article_raw"))


@query()
def p3_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.author_table(table(spark, sf_dir, "article_raw"))


@query(f"""select ref_key, 2 as ref_pos, 1 as cite_pos, nullif({_sql_strip("regexp_replace(title, '" + _B + "+', ' ', 'g')")}, '') as title, case when contains(doi, '10.') then substr(doi, instr(doi, '10.')) end as doi,
nullif({_sql_strip("regexp_replace(journal, '" + _B + "+', ' ', 'g')")}, '') as source, nullif({_sql_strip("regexp_replace(year, '" + _B + "+', ' ', 'g')")}, '') as year from cited_ref""")
def nested_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference relation as nested records of two references each, and their citations back from the levels."""
    cited = F.struct(
        F.col("title").alias("article-title"), F.struct(F.lit("doi").alias("@pub-id-type"), F.col("doi").alias("#text")).alias("pub-id"), F.col("journal").alias("source"), F.array("year").alias("year")
    )
    references = F.struct(F.struct(F.lit("1").alias("label"), F.lit(None).cast("string").alias("x")).alias("a"), F.struct(cited.alias("element-citation")).alias("b"))
    rows = table(spark, sf_dir, "cited_ref").select("ref_key", references.alias("r"))
    payload = F.concat(F.lit('{"back": {"ref-list": {"ref": ['), F.to_json("r.a"), F.lit(", "), F.to_json("r.b"), F.lit("]}}}"))
    return nested.citation_table(rows.select("ref_key", payload.alias("payload")), "ref_key")


@query(r"""with c as (select ref_key, authors from cited_ref where title is not null and authors is not null and not regexp_matches(authors, '[;|/"&\t\n•；、]|\band\b|et al')
 and regexp_full_match(authors, '[\p{L}''’-]+ [A-Z]{1,3}(, [\p{L}''’-]+ [A-Z]{1,3})*'))
select ref_key, cast(pos as int) as pos, author from (select ref_key, unnest(string_split(authors, ', ')) as author, generate_subscripts(string_split(authors, ', '), 1) as pos from c)""")
def packed_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of the commonest house style, split by the same operator as all others: what SQL can state of it."""
    cited = table(spark, sf_dir, "cited_ref").filter(F.col("title").isNotNull())
    plain = cited.filter(F.col("authors").rlike(r"^[\p{L}'’-]+ [A-Z]{1,3}(, [\p{L}'’-]+ [A-Z]{1,3})*$") & ~F.col("authors").rlike(r'[;|/"&\t\n•；、]|\band\b|et al'))
    return packed.split_packed(cited, "ref_key", "authors", "author").join(plain.select("ref_key"), "ref_key", "left_semi")


@query()
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = table(spark, sf_dir, "cited_ref").filter(F.col("title").isNotNull())
    return packed.split_packed(cited, "ref_key", "authors", "author")
