"""The operators applied to the driver tables with production parameters."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ahobpe, align, bpe, exact, htmltext, langid, packing, quality, resample, simhash, toxicity, urlrules, warc

#: Host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_simhash(spark, sf_dir):
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_exact(spark, sf_dir):
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op4_bpe(spark, sf_dir):
    return bpe.encode_texts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op5_warc(spark, sf_dir):
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op6_urlrules(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op7_langid(spark, sf_dir):
    return langid.languages(table(spark, sf_dir, "documents"))


def op8_html(spark, sf_dir):
    return htmltext.extract_main_text(table(spark, sf_dir, "pages"))


def op9_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_resample(spark, sf_dir):
    return resample.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_ahobpe(spark, sf_dir):
    return ahobpe.encode_texts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op13_align(spark, sf_dir):
    return align.align_tokenizers(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


OPERATORS = (
    op1_packing,
    op2_simhash,
    op3_exact,
    op4_bpe,
    op5_warc,
    op6_urlrules,
    op7_langid,
    op8_html,
    op9_quality,
    op10_toxicity,
    op11_resample,
    op12_ahobpe,
    op13_align,
)
QUERIES = {f.__name__: f for f in OPERATORS}

UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
SYMBOL_COUNT = "length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))"
STOPS = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))
SQL = {
    "op3_exact": f"""
        with t as (select doc_id, sha256(translate(coalesce(text, ''), {UPPER})) as s from documents)
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
               doc_id = max(doc_id) over w as kept, s as text_sha256
        from t window w as (partition by s)""",
    "op5_warc": """
        with t as (select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as s from pages),
        m as (select *, min(page_id) over (partition by s) as lead from t)
        select page_id, n as payload_bytes, s as payload_digest,
               case when n >= 100 and lead <> page_id then 'revisit' else 'response' end as record_type,
               case when n >= 100 and lead <> page_id then lead end as refers_to
        from m""",
    "op6_urlrules": f"""
        with p as (
            select page_id,
                   translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), {UPPER}) as host,
                   regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') as path
            from pages),
        r(rh, rp, verdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        m as (
            select page_id, host, path, rh || rp as rule, verdict,
                   row_number() over (partition by page_id order by length(rh) desc nulls last, length(rp) desc) as k
            from p left join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from m where k = 1""",
    "op9_quality": f"""
        with d as (select doc_id, coalesce(text, '') as t from documents),
        w as (select doc_id, t, list_filter(regexp_split_to_array(t, '[ \\t-\\r]+'), lambda x: x <> '') as w,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) as l from d),
        g as (select doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: struct_pack(p := i, s := w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as g from w),
        again as (select doc_id, g.p as p from g qualify count(*) over (partition by doc_id, g.s) > 1),
        hit as (select doc_id, count(distinct q) as n from (select doc_id, unnest([p, p + 1, p + 2]) as q from again) group by 1),
        c as (
            select w.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
                   {SYMBOL_COUNT}::bigint as n_symbols, len(l)::bigint as n_lines,
                   (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(hit.n, 0)::bigint as n_repeat_words,
                   len(list_filter(w, lambda x: lower(x) in ({STOPS})))::bigint as stops
            from w left join hit using (doc_id)),
        f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               not base_failed and word_chars >= 2 * n_words and word_chars <= 14 * n_words
               and n_symbols <= 0.25::double * n_words and stops >= 0.01::double * n_words and n_dup_lines <= 0.3::double * n_lines as kept
        from f""",
    "op11_resample": f"""
        with crc as (
            select list(c order by i) as tab from (
                select i, list_reduce(list_prepend(i::bigint, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
                from range(256) t(i))),
        x as (select 1 as side, row_number() over () as r, doc_id, text from documents union all select 2, row_number() over (), null, text from benchmark),
        w as (select side, r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {UPPER}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda v: v <> '') as w from x),
        f as (select side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from w),
        h as (select f, hex(encode(f)) as h from (select distinct f from f)),
        b as (
            select f, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::bigint)),
                                                  lambda c, v: xor(c >> 8, tab[(xor(c, v) & 255) + 1]))) % 10000 as bucket
            from h, crc),
        n as (select bucket, count(*) filter (side = 1) as s, count(*) filter (side = 2) as t from f join b using (f) group by 1),
        a as (select sum(s)::double as s_all, sum(t)::double as t_all from n),
        g as (select bucket, floor(1000 * ln(((t + 1) * (s_all + 10000)) / ((s + 1) * (t_all + 10000))))::bigint as gain from n, a),
        d as (select r, count(*) as n, sum(gain)::bigint as gain from f join b using (f) join g using (bucket) where side = 1 group by 1),
        e as (
            select doc_id, len(w) as words, coalesce(n, 0)::bigint as n_features, coalesce(floor(gain::double / n), 0)::bigint as weight,
                   ('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h
            from w left join d using (r) where side = 1),
        z as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score, words >= 20 as fit from e),
        o as (select *, row_number() over (partition by fit order by score desc, doc_id nulls last) as k, count(*) filter (fit) over () as n_fit from z)
        select doc_id, n_features, weight, score, case when fit and k <= 25 * n_fit // 100 then k end as rank from o""",
}
