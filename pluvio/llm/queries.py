"""The named queries of this package, and their SQL where DuckDB can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import stored
from . import bpe, fingerprints, jaccard_join, language_id, manifest, media, mixing, passages, pieces, pii, sharding, warc, whitening
from .common import materialize, table

SHARDS = 8


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_join.join(table(spark, sf_dir, "documents", "doc_id", "text"))
    return joined.select("doc_id", "n_shingles", "component_id", "n_links")


def op2_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", language_id.fold(F.col("doc_id")) == 0)
    model = language_id.train(docs, F.col("held_out"))
    return language_id.predict(docs, model, "doc_id", "held_out")


def op4_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_and_read(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_entropy_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op6_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"), with_ids=False)


def op8_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages written as WARC files, and a replica in which every 97th record (by id, from 13) has a changed byte; both are read back, and what is audited are the stored bytes."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    leaves, replica = (_through_files(spark, pages, damaged) for damaged in (None, F.pmod(F.col("page_id"), F.lit(97)) == 13))
    mine, theirs = materialize(warc.tree(leaves), "tree"), materialize(warc.tree(replica), "replica_tree")
    found = warc.audit(mine, theirs).select("file", "place", F.lit(True).alias("hit"))
    out = leaves.join(found, ["file", "place"], "left")
    return out.select("page_id", "length", F.col("digest").alias("record_sha256"), F.coalesce("hit", F.lit(False)).alias("corrupt"))


def _through_files(spark: SparkSession, pages: DataFrame, damaged: Column | None) -> DataFrame:
    """The leaves of the pages' files as they are stored; the files go once these are known."""
    folder = f"{stored.shared_dir(spark)}/pluvio-{uuid.uuid4().hex}"
    kept = stored.Kept(spark, folder)
    warc.write_files(pages, f"{folder}/warc", damaged=damaged)
    leaves = materialize(warc.stored_leaves(spark, f"{folder}/warc"), "leaves")
    kept.release()
    return leaves


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sharding.with_slots(table(spark, sf_dir, "documents", "doc_id", "text"))
    slot_map = materialize(sharding.first_map(sharding.slot_totals(records), SHARDS), "slot_map_v1")
    grown = sharding.grow_map(slot_map).select("virtual_slot", F.col("shard").alias("rebalanced_shard"))
    placed = sharding.place(records, slot_map).join(F.broadcast(grown), "virtual_slot")  # a row a virtual slot
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "rebalanced_shard"
    )


def op11_bpe_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"), with_ids=False)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit_documents(table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_pii_disclosure": op2_pii_disclosure,
    "op3_language_id": op3_language_id,
    "op4_media_chunks": op4_media_chunks,
    "op5_entropy_balance": op5_entropy_balance,
    "op6_merge_dropout": op6_merge_dropout,
    "op8_compact_windows": op8_compact_windows,
    "op7_merkle_audit": op7_merkle_audit,
    "op9_order_minhash": op9_order_minhash,
    "op10_virtual_slots": op10_virtual_slots,
    "op11_bpe_backtracking": op11_bpe_backtracking,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_whitening": op13_embedding_whitening,
}

_RECORD = """encode(concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', coalesce(cast(page_id as varchar), 'none'),
  '>', chr(13), chr(10), 'WARC-Date: 1970-01-01T00:00:00Z', chr(13), chr(10), 'WARC-Target-URI: ', regexp_replace(coalesce(url, ''), '[\\r\\n]', ' ', 'g'), chr(13), chr(10),
  'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', cast(strlen(coalesce(html, '')) as varchar), chr(13), chr(10), chr(13), chr(10), coalesce(html, ''), chr(13), chr(10), chr(13), chr(10)))"""

_JACCARD = r"""
    with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
    s as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) end s from w),
    n as (select doc_id, len(s)::bigint n from s), x as (select doc_id, unnest(s) k from s),
    p as (select a.doc_id a, b.doc_id b, count(*) c from x a join x b on a.k = b.k and a.doc_id <> b.doc_id group by 1, 2),
    l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 75 * (na.n + nb.n - c)),
    reach as (select doc_id a, doc_id b from n union select r.a, l.b from reach r join l on l.a = r.b)
    select n.doc_id, n.n n_shingles, m.component_id, coalesce(k.n_links, 0) n_links from n join (select a, min(b) component_id from reach group by 1) m on m.a = n.doc_id left join (select a, count(*) n_links from l group by 1) k on k.a = n.doc_id"""

_FIELDS = " || ".join(f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in ("doc_id", "source", "lang", "n_chars"))
_TEXT = "coalesce(strlen({0}) || ':' || {0}, '-')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SIBLINGS = """select tree, level, idx, n, coalesce(string_agg(digest, '') over (run rows between unbounded preceding and 1 preceding), '') before,
      coalesce(string_agg(digest, '') over (run rows between 1 following and unbounded following), '') after from {0} window run as (partition by tree, level, idx // 8 order by idx)"""
_UP = "select tree, level + 1, idx // 8, sha256(string_agg(digest, '' order by idx)), (n + 7) // 8 from {0} where n > 1 group by tree, level, idx // 8, n"
_FOLD = "select w.doc_id, w.leaf, w.tree, w.level + 1, w.idx // 8, sha256(s.before || w.digest || s.after), w.proof || s.before || s.after from {0} w join {1} s on (s.tree, s.level, s.idx) = (w.tree, w.level, w.idx) where s.n > 1"

_MANIFEST = f"""
    with recursive crc as (select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) t),
    leaves as (select doc_id, lang, sha256({_FIELDS} || {_TEXT.format('text')}) leaf, sha256({_FIELDS} || case when
        xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint)), lambda a, x: xor(t[1 + (xor(a, x) & 255)], a >> 8))) % 3 = 0
        then {_TEXT.format(_LOWER)} else {_TEXT.format('text')} end) claimed from documents, crc),
    placed as (select *, case when lang is null then '-' else '=' || lang end tree, row_number() over (partition by lang order by doc_id nulls first, leaf, claimed) - 1 idx, count(*) over (partition by lang) n from leaves),
    nodes as (select tree, 0 as level, idx, leaf as digest, n from placed union all {_UP.format('nodes')}),
    siblings as ({_SIBLINGS.format('nodes')}),
    ways as (select doc_id, leaf, tree, 0 as level, idx, claimed as digest, '' as proof from placed union all {_FOLD.format('ways', 'siblings')}),
    subroots as (select tree, digest subroot, row_number() over (order by tree) - 1 place, count(*) over () many from nodes where n = 1),
    over_nodes as (select '' as tree, 0 as level, place as idx, subroot as digest, many as n from subroots union all {_UP.format('over_nodes')}),
    over_siblings as ({_SIBLINGS.format('over_nodes')}),
    done as (select w.doc_id, w.leaf, r.tree of_tree, r.subroot, r.place idx, w.digest, w.proof from ways w join nodes t on (t.tree, t.level, t.idx) = (w.tree, w.level, w.idx) and t.n = 1 join subroots r on r.tree = w.tree),
    over_ways as (select doc_id, leaf, of_tree, subroot, '' as tree, 0 as level, idx, digest, proof from done union all select w.doc_id, w.leaf, w.of_tree, w.subroot, w.tree, w.level + 1, w.idx // 8, sha256(s.before || w.digest || s.after), w.proof || s.before || s.after
      from over_ways w join over_siblings s on (s.tree, s.level, s.idx) = (w.tree, w.level, w.idx) where s.n > 1)
    select w.doc_id, w.leaf, w.subroot, t.digest root, sha256(w.proof) proof_sha256, w.digest folded_root, w.digest = t.digest verified from over_ways w join over_nodes t on (t.level, t.idx) = (w.level, w.idx) and t.n = 1"""

ORACLE_SQL: dict[str, str] = {
    "op12_merkle_manifest": _MANIFEST,
    "op1_ngram_jaccard": _JACCARD,
    "op7_merkle_audit": f"""
        select page_id, octet_length(record) as length, sha256(record) as record_sha256, coalesce(page_id % 97 = 13, false) as corrupt
        from (select page_id, {_RECORD} as record from pages)""",
}
