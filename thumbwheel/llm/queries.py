"""The operators of this package as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thumbwheel.llm import ann, licenses
from thumbwheel.llm.html_text import extract_pages
from thumbwheel.llm.mixing import mix_documents
from thumbwheel.llm.neardup import near_duplicates
from thumbwheel.llm.packing import pack_documents
from thumbwheel.llm.phrases import mine_phrases
from thumbwheel.llm.quality import quality_verdicts
from thumbwheel.llm.substring import remove_repeats
from thumbwheel.llm.toxicity import classify_toxicity
from thumbwheel.llm.urls import UrlRule, domain_rule, filter_urls
from thumbwheel.llm.warc import read_archives, write_archives
from thumbwheel.llm.whitening import whiten
from thumbwheel.llm.words import table
from thumbwheel.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_warc(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch_path(spark, "archives")
    write_archives(spark, table(spark, d, "pages"), folder)
    return read_archives(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE["op1_warc"] = """
    with keyed as (select page_id, octet_length(encode(coalesce(html, ''))) payload_bytes,
                          sha256(coalesce(html, '')) payload_digest from pages),
    firsts as (select *, min(page_id) over (partition by payload_digest) first_id from keyed),
    kinds as (select *, payload_bytes >= 100 and page_id is distinct from first_id
                        and first_id is not null again from firsts)
    select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end record_type,
           case when again then first_id end refers_to from kinds
"""


@query
def op2_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    kept = remove_repeats(spark, table(spark, d, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op2_substring_dedup"] = r"""
    with worded as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                           lambda w: w <> '') w from documents),
    starts as (select doc_id, w, unnest(range(1, len(w) - 18)) s from worded),
    windows as (select doc_id, s, row_number() over (partition by array_to_string(w[s:s + 19], ' ')
                                                     order by doc_id, s) nth from starts),
    covered as (select distinct doc_id, unnest(range(s, s + 20)) p from windows where nth > 1),
    words as (select doc_id, unnest(w) word, unnest(range(1, len(w) + 1)) p from worded),
    kept as (select doc_id, count(*) n_words, count(c.p) n_removed,
                    string_agg(case when c.p is null then word end, ' ' order by p) t
             from words left join covered c using (doc_id, p) group by doc_id)
    select doc_id, coalesce(n_words, 0) n_words, coalesce(n_removed, 0) n_removed,
           sha256(coalesce(t, '')) kept_sha256
    from documents left join kept using (doc_id)
"""


@query
def op3_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(spark, table(spark, d, "documents"))


ORACLE["op3_near_duplicates"] = r"""
    with recursive worded as (select doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'), lambda w: w <> '') w from documents),
    sets as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) g from worded),
    shingles as (select doc_id, len(g) n, unnest(g) s from sets),
    pairs as (select a.doc_id a, b.doc_id b from shingles a join shingles b using (s)
              where a.doc_id < b.doc_id and least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 85
              group by 1, 2, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    links as (select a, b from pairs union all select b, a from pairs),
    reach as (select doc_id, doc_id r from documents
              union select l.b, r from reach join links l on l.a = reach.doc_id),
    roots as (select doc_id, min(r) component_id from reach group by 1)
    select doc_id, len(g)::bigint n_shingles, component_id, doc_id = component_id kept
    from sets join roots using (doc_id)
"""


# Share of tokens wanted of each domain; the labelled documents' languages are the domains.
MIX_TARGETS = {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.13}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The domain of the documents that the labels table lists."""
    return docs.select("doc_id", F.col("lang").alias("domain")).join(
        labels.select("doc_id").distinct(), "doc_id", "left_semi"
    )


@query
def op4_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return mix_documents(spark, docs, labelled_domains(docs, table(spark, d, "labels")), MIX_TARGETS)


@query
def op5_packing(spark: SparkSession, d: str) -> DataFrame:
    return pack_documents(spark, table(spark, d, "documents"))


@query
def op6_nearest_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return ann.search(spark, table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return classify_toxicity(spark, table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op8_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    verdicts = quality_verdicts(table(spark, d, "documents"), table(spark, d, "labels"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )


@query
def op9_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return extract_pages(table(spark, d, "pages"))


@query
def op10_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan_licences(table(spark, d, "documents")).drop("last_line")


ORACLE["op10_license_scan"] = licenses.oracle()


@query
def op11_embedding_whitening(spark: SparkSession, d: str) -> DataFrame:
    white = whiten(spark, table(spark, d, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


# The rules for hosts and paths.
DOMAIN_RULES = [
    domain_rule("block", "net"),
    domain_rule("allow", "example.net", "/en/"),
    domain_rule("block", "example.com", "/de/"),
    domain_rule("allow", "org", "/fr/"),
]

#: Patterns for what the rules above leave open; everything else is allowed.
URL_PATTERNS = [
    *(UrlRule(p, "block") for p in (
        "||adult-", "||xxx.", "||casino.", "||casino-", "||ads.", "||adserver.", "||tracker.", "/ads/", "/banner/",
        "/adult/", "/casino/", "/login^", "/signup^", "/cart^", "/checkout^", "/wp-admin/", "/cgi-bin/",
        "/search?*q=", ".exe^", ".apk^", "*sessionid=", "/tag/*/page/",
    )),
    *(UrlRule(p, "allow") for p in ("/wiki/login^", "||archive.*/search?*q=")),
]


@query
def op12_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return filter_urls(spark, table(spark, d, "pages"), [*DOMAIN_RULES, *URL_PATTERNS])


def _pattern_sql() -> str:
    """The longest pattern that fits, and its action, as one CASE over all patterns."""
    ordered = sorted(URL_PATTERNS, key=lambda r: r.rank, reverse=True)
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    # RE2 has no lookahead; its $ is the end of the text.
    fits = [f"when regexp_matches(target, {quoted(r.regex.replace('(?![\\s\\S])', '$'))})" for r in ordered]
    one = lambda of: "case " + " ".join(f"{w} then {quoted(of(r))}" for w, r in zip(fits, ordered)) + " end"
    return f"{one(lambda r: r.pattern)} pattern, {one(lambda r: r.action)} action"


ORACLE["op12_url_filter"] = rf"""
    with parts as (select page_id,
            translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz') host,
            coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') path,
            coalesce(regexp_extract(url, '://[^?#]*(\?[^#]*)', 1), '') query from pages),
    named as (select *, host || path || query target, case
            when ('.' || host) like '%.example.net' and starts_with(path, '/en/') then 'example.net/en/'
            when ('.' || host) like '%.example.com' and starts_with(path, '/de/') then 'example.com/de/'
            when ('.' || host) like '%.org' and starts_with(path, '/fr/') then 'org/fr/'
            when ('.' || host) like '%.net' and starts_with(path, '/') then 'net/' end rule from parts),
    judged as (select *, {_pattern_sql()} from named)
    select page_id, host, path, rule, case when rule is null then pattern end pattern,
           case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
                else coalesce(action, 'allow') end verdict
    from judged
"""


@query
def op13_phrase_mining(spark: SparkSession, d: str) -> DataFrame:
    return mine_phrases(spark, table(spark, d, "documents")).drop("first_doc", "first_word")


ORACLE["op13_phrase_mining"] = r"""
    with pieces as (select coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) p from documents),
    worded as (select lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') w from pieces),
    totals as (select lang, sum(len(w))::bigint n from worded group by 1),
    grams as (select lang, w, k, unnest(range(1, len(w) - k + 2)) i from worded, (select unnest(range(1, 6)) k)),
    counts as (select lang, array_to_string(w[i:i + k - 1], ' ') phrase, k, count(*) a from grams
               group by 1, 2, 3 having count(*) >= 100),
    parts as (select *, string_split(phrase, ' ') w from counts where k > 1),
    cuts as (select *, unnest(range(1, k)) c from parts),
    sides as (select s.lang, s.phrase, s.k, s.a, c, l.a l, r.a r, n,
                     ((1000::hugeint * s.a * n) // (l.a::hugeint * r.a))::bigint score
              from cuts s join totals using (lang)
              join counts l on l.lang = s.lang and l.phrase = array_to_string(s.w[1:c], ' ')
              join counts r on r.lang = s.lang and r.phrase = array_to_string(s.w[c + 1:s.k], ' ')),
    best as (select *, row_number() over (partition by lang, phrase order by score, c) nth from sides),
    spans as (select lang, a, w, k, m, unnest(range(1, k - m + 2)) i
              from parts, (select unnest(range(2, 5)) m) where m < k),
    longer as (select lang, array_to_string(w[i:i + m - 1], ' ') phrase, max(a) longer from spans group by 1, 2),
    kept as (select b.* from best b left join longer o using (lang, phrase)
             where nth = 1 and (longer is null or 100 * longer < 100 * a)),
    ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) rank from kept)
    select lang, rank, phrase, a, l, r, n, score, k words from ranked where rank <= 2000
"""
