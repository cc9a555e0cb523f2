"""Registered queries of the operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm import collocations, hard_negatives, langid, licenses, quality_rules, sentencepiece_fst, toxicity, transcripts
from verdant.llm.common import fold, read_table
from verdant.llm.decontaminate import find_contamination
from verdant.llm.projection_dedup import find_near_duplicates as find_near_vectors
from verdant.llm.simhash import find_near_duplicates
from verdant.llm.token_shards import write_store
from verdant.llm.warc import write_archives

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words inside benchmark windows, and the items concerned."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark"), out="m")
    items = F.array_sort("m.items")
    return found.select("doc_id", F.col("m.n_words").alias("n_words"), F.col("m.n_hit").alias("n_hit"),
                        F.size("m.items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
                        (F.col("m.n_hit") > 0).alias("contaminated"))


_WORD_LIST = f"regexp_extract_all(coalesce({LOWER}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP4_SQL = f"""
with d as (select doc_id, {_WORD_LIST} as w from documents),
     b as (select item_id, {_WORD_LIST} as w, least(10, len(w)) as k from benchmark where len(w) > 0),
     bw as (select distinct item_id, k, array_to_string(w[j:j + k - 1], ' ') as win
            from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as j from b)),
     ks as (select distinct k from b),
     dp as (select doc_id, w, unnest(range(1, len(w) + 1)) as p from d),
     dw as (select doc_id, p, k, array_to_string(w[p:p + k - 1], ' ') as win
            from dp, ks where p + k - 1 <= len(w)),
     hit as (select doc_id, p, k, item_id from dw join bw using (k, win)),
     pos as (select doc_id, count(distinct q) as n_hit
             from (select doc_id, unnest(range(p, p + k)) as q from hit) group by doc_id),
     its as (select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as names
             from (select distinct doc_id, cast(item_id as varchar) as i from hit) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join pos using (doc_id) left join its using (doc_id)
"""

def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: SimHash fingerprint and near-duplicate component."""
    found = find_near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_token_store(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Per document, looked up by key in the written store and read from its shard."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    store = write_store(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    found = store.find(docs, "doc_id").unionByName(store.unkeyed())
    return store.load(found, digest=True).select(F.col("key").cast("long").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page, looked up in the capture index and read from its archive record."""
    pages = read_table(spark, sf_dir, "pages")
    index = write_archives(pages)
    return index.read(index.lookup(pages), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: direct links, component, and whether it represents its component."""
    return find_near_vectors(read_table(spark, sf_dir, "embeddings"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: toxicity score of the whole text and the decision at 0.7."""
    docs = read_table(spark, sf_dir, "documents")
    labels = toxicity.training_rows(read_table(spark, sf_dir, "labels"))
    model = toxicity.learn(docs, labels)
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model, out="t")
    score = F.col("t.score")
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), score.alias("score"),
                         (score >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: predicted language of the whole text and its score."""
    docs = read_table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(fold("doc_id", 4) != 2))
    named = langid.identify(docs.select("doc_id", "text"), model, out="l")
    return named.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), F.col("l.lang").alias("lang_pred"),
                        F.col("l.score").alias("score"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Per document: number and crc32 of the ids, and whether decoding gives the text back."""
    import public_tokenizers

    path = model or public_tokenizers.path("piece_bpe_32k.model")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (docs.withColumn("d", sentencepiece_fst.digest_column(path, F.col("text")))
                .select("doc_id", "d.n_ids", "d.ids_crc32", "d.round_trip"))


def op7_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per canonical turn of each conversation: recovered role, and digest of the rendered turn."""
    rows = read_table(spark, sf_dir, "conversations")
    model = transcripts.learn(rows.where(fold("conv_id", 4) != 2))
    turns = transcripts.parse(rows, model)
    return turns.select("conv_id", "turn", "part", (fold("conv_id", 4) == 2).alias("held_out"), "role",
                        F.length("text").cast("long").alias("n_chars"), F.sha2("rendered", 256).alias("rendered_sha256"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, confirmed licence notices and their families."""
    docs = read_table(spark, sf_dir, "documents")
    found = licenses.scan_documents(docs, licenses.learn(docs))
    return found.select("doc_id", "n_lines", "n_notices", "families", "unconfirmed", "probability")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: the 2,000 best phrases of two and three words."""
    docs = read_table(spark, sf_dir, "documents")
    best = collocations.mine(docs, max_words=3, min_count=10, top=2000)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts, base rules, probability of good quality and the verdict."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality_rules.learn(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs.select("doc_id", "text"), model, out="q").select("doc_id", "q.*")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per anchor and positive: the first hard negatives, with exact integer scores."""
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, F.col("id") % 50 == 0, label=label)


LLM_QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_language": op2_language,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash": op5_simhash,
    "op6_token_store": op6_token_store,
    "op7_transcripts": op7_transcripts,
    "op8_projection": op8_projection,
    "op9_licenses": op9_licenses,
    "op10_warc": op10_warc,
    "op11_collocations": op11_collocations,
    "op12_quality_rules": op12_quality_rules,
    "op13_hard_negatives": op13_hard_negatives,
}

# Base32 of SHA-1 from its 40 hex digits: 8 digits of 5 bits for every 10 hex digits.
_QUADS = ", ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast((('0x' || substr(sha1(p), {10 * k + 1}, 10))::bigint "
                   f">> {35 - 5 * j}) & 31 as integer), 1)" for k in range(4) for j in range(8))
OP10_SQL = f"""
with t as (select page_id, coalesce(html, '') as p from pages),
     d as (select page_id, cast(strlen(p) as bigint) as payload_bytes, concat({_QUADS}) as payload_digest from t),
     w as (select *, min(page_id) over (partition by payload_digest) as first_id from d)
select page_id, payload_bytes, payload_digest,
       case when page_id > first_id then 'revisit' else 'response' end as record_type,
       case when page_id > first_id then first_id end as refers_to
from w
"""

OP8_SQL = """
with recursive v as (
       select vec_id, cast(embedding as double[]) as e from embeddings
       where vec_id is not null and embedding is not null and len(embedding) > 0
         and len([x for x in embedding if x is null or not isfinite(x)]) = 0
         and len([x for x in embedding if x <> 0]) > 0),
     links as (
       select a.vec_id as a, b.vec_id as b from v a join v b
       on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95),
     reach as (select a as node, b as seen from links
               union select r.node, l.b from reach r join links l on l.a = r.seen),
     least as (select node, min(seen) as seen from reach group by node),
     linked as (select a, count(*) as n from links group by a)
select e.vec_id, cast(coalesce(n, 0) as bigint) as n_links, least(e.vec_id, coalesce(l.seen, e.vec_id)) as component_id,
       e.vec_id = least(e.vec_id, coalesce(l.seen, e.vec_id)) as kept
from embeddings e left join least l on l.node = e.vec_id left join linked k on k.a = e.vec_id
"""

OP13_SQL = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  [cast(floor(256 * cast(x as double)) as double) for x in embedding] as e
           from embeddings
           where label is not null and embedding is not null
             and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
     s as (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
                  cast(list_dot_product(a.e, b.e) as bigint) as score
           from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
     p as (select anchor_id, other_id as positive_id, score as positive_score from s where same
           qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
     n as (select p.*, other_id as negative_id, score as negative_score,
                  row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as rank
           from p join s using (anchor_id)
           where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from n where rank <= 3
"""

# Pieces end at the marks and line ends; a word's place within its piece bounds the phrases that start there.
OP11_SQL = f"""
with d as (select row_number() over () as doc, coalesce(lang, 'und') as lang, {LOWER} as t from documents),
     p as (select doc, lang, unnest(regexp_split_to_array(coalesce(t, ''), '[.,;:!?\\x0A-\\x0D]')) as piece from d),
     w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from p),
     n as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
     g as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, w[i:i + k - 1] as ws
           from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, (values (1), (2), (3)) ks(k))),
     f as (select lang, k, phrase, any_value(ws) as ws, count(*) as a from g group by lang, k, phrase having count(*) >= 10),
     parts as (select lang, k, phrase, ws, a, j, array_to_string(ws[1:j], ' ') as head, array_to_string(ws[j + 1:k], ' ') as tail
               from (select *, unnest(range(1, k)) as j from f where k >= 2)),
     cuts as (select p.lang, p.k, p.phrase, p.ws, p.a, j, x.a as l, y.a as r,
                     cast((1000000::hugeint * p.a * p.a) // (x.a::hugeint * y.a) as bigint) as score
              from parts p join f x on x.lang = p.lang and x.phrase = p.head join f y on y.lang = p.lang and y.phrase = p.tail),
     c as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
     inner2 as (select lang, phrase, max(a) as over
                from (select lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) as phrase from f where k = 3)
                group by all),
     kept as (select c.* from c left join inner2 using (lang, phrase) where not (k = 2 and over is not null and 100 * over >= 50 * a)),
     top as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select top.lang, rank, phrase, a, l, r, n.n, score from top join n on n.lang = top.lang where rank <= 2000
"""

LLM_ORACLE = {
    "op11_collocations": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
    "op8_projection": OP8_SQL,
    "op10_warc": OP10_SQL,
    "op4_decontaminate": OP4_SQL,
}
