"""The registered queries of this subpackage: ``op<N>_<name>`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, fim, idfile, mixing, ngramjoin, ngramlm, pieces, secrets, sourceaudit, suffixdedup, tokencounts, toxicity, vecdedup
from .workspace import documents_of


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file; the package that has them is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: The number at the end of a source's name places it in a domain; names without one are "other".
DOMAINS = ("web", "books", "code", "reference")


def domain_of(source: Column) -> Column:
    number = F.regexp_extract(source, r"([0-9]+)$", 1)
    out = F.lit("other")
    for k, name in enumerate(DOMAINS):
        out = F.when((number != "") & (number.try_cast("long") % len(DOMAINS) == k), F.lit(name)).otherwise(out)
    return out


def mixture(**changes) -> mixing.Mix:
    settings = {
        "levels": [("domain", domain_of(F.col("source"))), ("lang", F.col("lang")), ("source", F.col("source"))],
        "weights": {"domain": {"web": 4, "books": 3, "code": 2, "reference": 1}, "lang": {"en": 5, "fr": 2, "de": 2, "es": 2}},
        "budget": (3, 4),
        "max_epochs": 4,
        "seed": "mix-1",
    }
    return mixing.Mix(**(settings | changes))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(spark.read.parquet(f"{sf_dir}/documents.parquet"), mixture())


def _fill_sql(given: str, nodes: str, parent: str, name: str) -> str:
    """CTEs that divide ``budget`` of each parent in ``nodes`` among its children as ``given``."""
    over = f"PARTITION BY {parent}" if parent else ""
    rank = f"{over} ORDER BY CASE WHEN weight > 0 THEN cap::DOUBLE / weight END ASC NULLS LAST, {name}"
    return f"""
{given}_a AS (SELECT *, cap::HUGEINT * sum(weight) OVER ({rank} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= (budget - (sum(cap) OVER ({rank} ROWS UNBOUNDED PRECEDING) - cap)) * weight AS is_full FROM {nodes}),
{given}_b AS (SELECT *, budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({over}), 0) AS rest,
    coalesce(sum(CASE WHEN NOT is_full THEN weight END) OVER ({over}), 0) AS open_w FROM {given}_a),
{given}_c AS (SELECT *, CASE WHEN is_full OR open_w = 0 THEN 0 ELSE (rest * weight) // open_w END AS share FROM {given}_b),
{given}_d AS (SELECT *, rest - sum(share) OVER ({over}) AS left_over, row_number() OVER ({over}
    ORDER BY CASE WHEN NOT is_full THEN rest * weight - share * open_w END DESC NULLS LAST, {name}) AS turn FROM {given}_c),
{given} AS (SELECT * EXCLUDE (budget), CASE WHEN is_full THEN cap
    ELSE share + CASE WHEN open_w > 0 AND turn <= left_over THEN 1 ELSE 0 END END::BIGINT AS given FROM {given}_d)"""


_NUMBER = "try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT)"
OP1_SQL = f"""
WITH units AS (
  SELECT doc_id, CASE {_NUMBER} % 4 WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'code' WHEN 3 THEN 'reference' ELSE 'other' END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    sum(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0))::BIGINT AS n_tokens
  FROM documents GROUP BY ALL),
leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS avail, 4 * sum(n_tokens)::BIGINT AS cap,
    CASE domain WHEN 'web' THEN 4 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END::BIGINT AS w1,
    CASE lang WHEN 'en' THEN 5 WHEN 'fr' THEN 2 WHEN 'de' THEN 2 WHEN 'es' THEN 2 ELSE 1 END::BIGINT AS w2
  FROM units GROUP BY domain, lang, source),
total AS (SELECT (coalesce(sum(avail), 0)::BIGINT * 3 // 4)::HUGEINT AS budget FROM leaves),
n1 AS (SELECT domain, sum(cap)::HUGEINT AS cap, max(w1)::HUGEINT AS weight, any_value(budget) AS budget FROM leaves, total GROUP BY domain),
{_fill_sql("g1", "n1", "", "domain")},
n2 AS (SELECT l.domain, l.lang, sum(l.cap)::HUGEINT AS cap, max(w2)::HUGEINT AS weight, any_value(g.given)::HUGEINT AS budget
  FROM leaves l JOIN g1 g USING (domain) GROUP BY l.domain, l.lang),
{_fill_sql("g2", "n2", "domain", "lang")},
n3 AS (SELECT l.domain, l.lang, l.source, l.cap::HUGEINT AS cap, 1::HUGEINT AS weight, g.given::HUGEINT AS budget
  FROM leaves l JOIN g2 g USING (domain, lang)),
{_fill_sql("g3", "n3", "domain, lang", "source")},
planned AS (SELECT domain, lang, source, CASE WHEN avail = 0 THEN 0 ELSE given // avail END::BIGINT AS epochs,
    CASE WHEN avail = 0 THEN given ELSE given % avail END::BIGINT AS prefix
  FROM leaves JOIN g3 USING (domain, lang, source)),
placed AS (SELECT u.*, p.epochs, p.prefix,
    sum(n_tokens) OVER (PARTITION BY domain, lang, source
      ORDER BY md5(concat('mix-1:', p.epochs, ':', coalesce(doc_id::VARCHAR, 'null'))), doc_id, n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS first_at
  FROM units u JOIN planned p USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, epochs,
  greatest(0, least(n_tokens, prefix - first_at))::BIGINT AS prefix_tokens,
  (epochs + CASE WHEN first_at < prefix THEN 1 ELSE 0 END)::BIGINT AS copies
FROM placed"""


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join_components(_docs(spark, sf_dir), k=5, percent=75)


def op3_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(_docs(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def op4_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramlm.train_and_score(_docs(spark, sf_dir), folds=10)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_docs(spark, sf_dir))


def op6_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfile.round_trip(_docs(spark, sf_dir), tokenizer("word_bpe_49k.json"), end_id=2)


#: Tokens beyond which a document does not fit a training context.
CONTEXT = 4096


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokencounts.count_tokens(_docs(spark, sf_dir), tokenizer("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


def op8_permutation_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, k=10)


def op9_vector_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vecdedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.93)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), folds=5)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(5).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.dedup(_docs(spark, sf_dir)).drop("spans")


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sourceaudit.audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY w.lang, w.source, w.term),
sizes AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
totals AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (t.total + s.v) AS p
  FROM totals t JOIN kept k ON t.lang = k.lang JOIN sizes s ON t.lang = s.lang LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
whole AS (SELECT c.lang, c.term, sum(c.n)::HUGEINT AS n FROM c GROUP BY c.lang, c.term),
alls AS (SELECT lang, sum(n)::HUGEINT AS total FROM whole GROUP BY lang),
q AS (SELECT w.lang, w.term, 1 + (1000000000::HUGEINT * (w.n + 1)) // (a.total + s.v) AS q FROM whole w JOIN alls a ON w.lang = a.lang JOIN sizes s ON w.lang = s.lang),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
none AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, 0::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM sizes)),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p.p - q.q) * (p.p - q.q) // q.q)::BIGINT AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM none UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(_docs(spark, sf_dir), keep_text=False)


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id::VARCHAR) AS x FROM documents),
h AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
    ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2, ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM d),
f AS (SELECT *, len(lines)::BIGINT AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, coalesce(array_to_string(lines[1:a], ''), '') AS pre, coalesce(array_to_string(lines[a + 1:b], ''), '') AS mid, coalesce(array_to_string(lines[b + 1:], ''), '') AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE pre || mid || suf END) AS restored_sha256
FROM p"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_piece_round_trip": op3_piece_round_trip,
    "op4_ngram_lm": op4_ngram_lm,
    "op5_secret_scan": op5_secret_scan,
    "op6_token_id_files": op6_token_id_files,
    "op7_token_counts": op7_token_counts,
    "op8_permutation_ann": op8_permutation_ann,
    "op9_vector_near_dups": op9_vector_near_dups,
    "op10_toxicity": op10_toxicity,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_source_audit": op12_source_audit,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {"op1_mix_sources": OP1_SQL, "op12_source_audit": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
