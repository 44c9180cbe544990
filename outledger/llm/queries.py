"""The registered queries of the text operators and their check SQL.

Each query applies one operator to its whole table with production parameters and derives the
columns of its contract from the operator's output.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from outledger.llm import (
    conversation_trie,
    decontamination,
    license_scan,
    ngram_join,
    phrase_dedup,
    pii,
    piece_codec,
    quality_model,
    quality_rules,
    substring_dedup,
    target_resampling,
    token_counts,
    warc,
)
from outledger.llm.common import table
from outledger.session import run_dir

ROOT = str(Path(__file__).resolve().parents[2])

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a text query; without SQL its tests compare it with brute force."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            # Tasks import this package wherever the session was started from.
            paths = spark.sparkContext.environment
            if ROOT not in paths.get("PYTHONPATH", "").split(os.pathsep):
                known = [paths["PYTHONPATH"]] if paths.get("PYTHONPATH") else []
                paths["PYTHONPATH"] = os.pathsep.join([ROOT, *known])
            return fn(spark, folder)

        run.text_operator = True
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


PIECES = "piece_bpe_32k.model"


@query(
    "op1_decontamination",
    r"""
    with d as (
        select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)),
            lambda i: array_to_string(w[i:i + 4], ' '))) as s
        from (select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
            lambda x: x <> '') as w from documents where text is not null)
        where len(w) >= 5
    ), b as (
        select distinct item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)),
            lambda i: array_to_string(w[i:i + 4], ' '))) as s
        from (select item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
            lambda x: x <> '') as w from benchmark where text is not null)
    ), n as (
        select item_id, count(*) as n_shingles from b group by item_id
    )
    select doc_id, item_id, n_shingles, count(*) as n_found, count(*) / n_shingles as containment
    from d join b using (s) join n using (item_id)
    group by doc_id, item_id, n_shingles
    having count(*) * 100 >= n_shingles * 75
    """,
)
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items inside all documents."""
    return decontamination.contaminated(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    ).drop("text_key")


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents; labels of held-out documents are never learned from."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = quality_model.quality_scores(
        table(spark, folder, "documents"), table(spark, folder, "labels"), ~held_out
    )
    return rows.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query(
    "op3_substring_dedup",
    """
    with h as (
        select doc_id, hex(encode(coalesce(text, ''))) as h from documents
    ), w as (
        select doc_id, i, md5(substr(h, 2 * i + 1, 400)) as k
        from (select doc_id, h, unnest(range(0, len(h) // 2 - 199)) as i from h)
    ), s as (
        select doc_id, i from (select *, count(*) over (partition by k) as n from w) where n > 1
    ), m as (
        select *, i > coalesce(lag(i) over (partition by doc_id order by i) + 200, -1) as fresh
        from s
    ), r as (
        select *, sum(fresh::int) over (partition by doc_id order by i) as run from m
    ), p as (
        select doc_id, min(i) as a, max(i) + 200 as b from r group by doc_id, run
    ), g as (
        select *, coalesce(lag(b) over (partition by doc_id order by a), 0) as before from p
    ), t as (
        select h.doc_id, count(g.a) as n_spans, coalesce(sum(g.b - g.a), 0)::bigint as n_removed,
            coalesce(string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a), '')
                || substr(h, 2 * coalesce(max(b), 0) + 1) as kept,
            len(h) // 2 as n_bytes
        from h left join g on h.doc_id = g.doc_id group by h.doc_id, h
    )
    select doc_id, n_bytes, n_removed, n_spans, sha256(unhex(kept)) as kept_sha256 from t
    """,
)
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the bytes of repeated 200-byte strings."""
    return substring_dedup.without_repeats(table(spark, folder, "documents")).drop("kept")


@query(
    "op4_ngram_jaccard",
    r"""
    with recursive w as (
        select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
    ), s as (
        select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
            lambda i: array_to_string(w[i:i + 4], ' '))) as s from w where len(w) > 0
    ), n as (
        select doc_id, count(*) as n from s group by doc_id
    ), l as (
        select a.doc_id as a, b.doc_id as b
        from s a join s b on a.s = b.s and a.doc_id <> b.doc_id
            join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
        group by a.doc_id, b.doc_id, x.n, y.n
        having 100 * count(*) >= 75 * (x.n + y.n - count(*))
    ), r as (
        select doc_id as a, doc_id as b from documents
        union
        select r.a, l.b from r join l on l.a = r.b
    )
    select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, r.c as component_id
    from documents d left join n using (doc_id)
        join (select a, min(b) as c from r group by a) r on r.a = d.doc_id
    """,
)
def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of near-equal documents."""
    rows = ngram_join.jaccard_components(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id")


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Quality rules over all documents."""
    rows = quality_rules.quality(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Word-piece lengths of all documents."""
    model = public_tokenizers.path(PIECES)
    return token_counts.token_counts(table(spark, folder, "documents"), str(model))


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Encoding and decoding of all documents."""
    model = public_tokenizers.path(PIECES)
    return piece_codec.round_trip(table(spark, folder, "documents"), str(model))


@query("op8_license_scan")
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence labels of all documents."""
    rows = license_scan.scan(table(spark, folder, "documents"))
    found = F.transform("matches", lambda m: m["label"])
    labels = F.array_sort(F.array_union("base_labels", found))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


@query(
    "op9_warc",
    """
    with p as (
        select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
    ), k as (
        select *, max(page_id) over (partition by html) as m from p
    )
    select page_id, octet_length(encode(html))::bigint as payload_bytes,
        array_to_string(list_transform(range(32), lambda i:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(h, (i // 8) * 10 + 1, 10))::bigint
                    >> (35 - 5 * (i % 8))::bigint) & 31)::int + 1, 1)), '') as payload_digest,
        case when page_id = m then 'response' else 'revisit' end as record_type,
        case when page_id = m then null else m end as refers_to
    from k
    """,
)
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as archives and read back."""
    uri = f"{run_dir(spark)}/warc-{uuid.uuid4().hex}"
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    warc.write_archives(table(spark, folder, "pages"), uri, shards)
    return warc.read_archives(spark, uri, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op10_pii")
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of all documents."""
    rows = pii.personal_data(table(spark, folder, "documents"))

    def count(number: int):
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    return rows.select(
        "doc_id",
        *(count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)),
        F.sha2(F.encode(pii.listed(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@query(
    "op11_substring_dedup",
    r"""
    with w as (
        select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
    ), k as (
        select doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) as k
        from (select doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) as i from w)
    ), s as (
        select distinct doc_id, j from (
            select doc_id, unnest(range(i, i + 13)) as j
            from (select *, min(doc_id) over (partition by k) as least from k) where least < doc_id)
    ), g as (
        select doc_id, list(j) as gone from s group by doc_id
    )
    select doc_id, len(w)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed,
        sha256(coalesce(array_to_string(case when gone is null then w else
            list_filter(w, lambda x, i: not list_contains(gone, i)) end, ' '), '')) as kept_sha256
    from w left join g using (doc_id)
    """,
)
def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the passages that earlier documents hold."""
    return phrase_dedup.without_repeats(table(spark, folder, "documents"))


@query(
    "op12_target_resampling",
    r"""
    with d as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
    ), b as (
        select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
    ), e as (
        select doc_id, f, count(*) as n from (
            select doc_id, unnest(list_concat(w, list_transform(range(1, len(w)),
                lambda i: w[i] || ' ' || w[i + 1]))) as f from d) group by doc_id, f
    ), g as (
        select f, count(*) as n from (
            select unnest(list_concat(w, list_transform(range(1, len(w)),
                lambda i: w[i] || ' ' || w[i + 1]))) as f from b) group by f
    ), c as (
        select i::int as i, list_reduce(range(0, 8), lambda x, k:
            case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, i) as v
        from range(0, 256) t(i)
    ), t as (
        select list(v order by i) as t from c
    ), x as (
        select f, xor(list_reduce(list_transform(range(0, octet_length(encode(f))), lambda i:
            ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::bigint), lambda x, y:
            xor(x >> 8, t[(xor(x, y) & 255) + 1]), 4294967295), 4294967295) % 10000 as bucket
        from (select distinct f from (select f from e union all select f from g)), t
    ), s as (
        select bucket, sum(n)::bigint as s from e join x using (f) group by bucket
    ), u as (
        select bucket, sum(n)::bigint as t from g join x using (f) group by bucket
    ), k as (
        select (select coalesce(sum(s), 0)::bigint from s) as s, (select coalesce(sum(t), 0)::bigint from u) as t
    ), gain as (
        select bucket, floor(1000 * ln(((coalesce(u.t, 0) + 1) * (k.s + 10000))
            / ((s.s + 1) * (k.t + 10000))))::bigint as gain
        from s left join u using (bucket), k
    ), m as (
        select doc_id, sum(n)::bigint as n_features, floor(sum(n * gain) / sum(n))::bigint as weight
        from e join x using (f) join gain using (bucket) group by doc_id
    ), r as (
        select d.doc_id, len(w) as n_words, coalesce(n_features, 0)::bigint as n_features,
            coalesce(weight, 0)::bigint as weight,
            coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' ||
                substr(sha256('7:' || d.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
        from d left join m using (doc_id)
    ), o as (
        select doc_id, row_number() over (order by score desc, doc_id) as k, count(*) over () as n
        from r where n_words >= 20
    )
    select r.doc_id, n_features, weight, score, case when k <= 25 * n // 100 then k end as rank
    from r left join o using (doc_id)
    """,
)
def op12_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of all documents, drawn towards the benchmark texts."""
    rows = target_resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


@query(
    "op13_conversation_trie",
    r"""
    with t as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over
            (partition by conv_id order by turn nulls first) - 1 as i
        from conversations where conv_id is not null
    ), z as (
        select list(v order by i) as t from (select i::int as i, list_reduce(range(0, 8), lambda x, k:
            case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, i) as v
            from range(0, 256) s(i))
    ), c as (
        select conv_id, conv_id - conv_id % 20 as base, xor(list_reduce(list_transform(
            range(1, length(conv_id::varchar) + 1), lambda i: ascii(substr(conv_id::varchar, i, 1))::bigint),
            lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1]), 4294967295), 4294967295) % 4 as h
        from (select distinct conv_id from t), z
    ), r as (
        select c.conv_id, i, role, text from c join t on t.conv_id = c.base and i < h
        union all
        select conv_id, i, role, text from t join c using (conv_id) where i >= h
    ), l as (
        select c.conv_id, coalesce(list({'r': role, 't': text} order by i) filter (i is not null), []) as l
        from c left join r using (conv_id) group by c.conv_id
    ), p as (
        select conv_id, len(l) as n, unnest(range(0, len(l) + 1)) as d, l[1:d] as k from l
    ), n as (
        select d, k, min(conv_id) as conv_id, count(*) as n_convs, coalesce(string_agg(conv_id::varchar, ','
            order by conv_id) filter (n = d), '') as ends,
            (count(*) - 1) * coalesce(len(regexp_extract_all(k[d].t, '[^\x20\x09-\x0D]+')), 0) as own
        from p group by d, k
    ), m as (
        select n.*, count(b.conv_id) as n_children
        from n left join n b on b.d = n.d + 1 and b.k[1:b.d - 1] = n.k group by all
    ), s as (
        select p.d, p.k, count_if(m.n_children = 0) as n_leaves, sum(m.own)::bigint as saved_tokens
        from m join p on p.conv_id = m.conv_id and p.d <= m.d group by p.d, p.k
    )
    select m.conv_id, m.d as depth, a.conv_id as parent_conv_id, m.n_convs, m.n_children,
        n_leaves::bigint as n_leaves, saved_tokens, sha256(m.ends) as ends_sha256
    from m join s on s.d = m.d and s.k = m.k left join n a on a.d = m.d - 1 and a.k = m.k[1:m.d - 1]
    """,
)
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Prefix trie of all conversations."""
    rows = conversation_trie.prefix_trie(table(spark, folder, "conversations"))
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, folder)
