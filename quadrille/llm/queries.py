"""The queries op1 to op10 over the text tables, with production parameters, and their SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where a public vocabulary file lies; the files are never copied into this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), F.col("__sha256").alias("kept_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import scratch_path
    from .warc import read_archives, write_archives

    folder = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder).agg({"records": "sum"}).collect()
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "keep")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .forest import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


#: The rules of op6 as (verdict, host, path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urlrank import judge

    return judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .multiset import fingerprint_edits

    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op8_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import score_documents
    from .quality import remainder

    return score_documents(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 10) == 0)


def op9_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(quality.remainder(F.col("doc_id"), 4) == 2, F.lit(False))  # a row without an id is not held out
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score(docs, model)
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), vocabulary_path())


# Parts of the queries above that SQL can express.


def url_rule_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op6 returns for pages that a rule decides."""
    return op6_url_filter(spark, sf_dir).where("rule is not null").select("page_id", "host", "path", "rule", "verdict")


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edited texts of op7 by their digests."""
    return op7_multiset_hash(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 learning from all documents: counts and the base score, to three decimals."""
    from .lm import score_documents

    found = score_documents(table(spark, sf_dir, "documents"), F.lit(False))
    return found.select("doc_id", "n_tokens", "n_known", "train_tokens", F.round("base_score", 3).alias("base_score"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
    numbered = dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
    return numbered | {f.__name__: f for f in (url_rule_verdicts, edited_texts, lm_base_scores)}


_OP1_SQL = r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
  windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)),
  repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
  covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows WHERE h IN (SELECT h FROM repeated)),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w) AS words ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""

_OP2_SQL = """WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
  g AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to FROM p LEFT JOIN g USING (payload_digest)"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_RULES_SQL = f"""WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
  r(verdict, h, p) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
  f AS (SELECT u.*, r.h || r.p AS rule, r.verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(r.h || r.p) DESC) AS k FROM u JOIN r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p))
SELECT page_id, host, path, rule, verdict FROM f WHERE k = 1"""

_EDITED_SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id), '') AS n FROM documents)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(substring(t, 1, length(t) - length(t) // 4) || substring(n, 1, length(t) // 4)) AS edited_sha256 FROM d"""

_BASE_SQL = rf"""WITH w AS (SELECT doc_id, unnest(list_append(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^ 	-]+'), ' ')) AS word FROM documents),
  c AS (SELECT word, count(*) AS c FROM w GROUP BY word), s AS (SELECT sum(c) AS n, count(*) AS v FROM c)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_tokens, CAST(count(*) AS BIGINT) AS n_known, CAST(any_value(n) AS BIGINT) AS train_tokens,
  round(sum(log10(c + 0.1e0) - log10(n + 0.1e0 * (v + 1))), 3) AS base_score FROM w JOIN c USING (word), s GROUP BY doc_id"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the others are tested against brute force."""
    return {"op1_substring_dedup": _OP1_SQL, "op2_warc": _OP2_SQL, "url_rule_verdicts": _RULES_SQL, "edited_texts": _EDITED_SQL, "lm_base_scores": _BASE_SQL}
