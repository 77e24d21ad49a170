"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import ann, collocations, decontaminate, html_text, language_id, ngram_join, packing, periodic_runs, pii, quality, sharding, token_counts, toxicity
from tillroll.llm.common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(doc_id) -> "F.Column":
    """Documents that op1 must not learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~held_out("doc_id")))
    return language_id.with_language(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model).drop("text")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), keep=["doc_id"], spans="found")
    base = F.filter("found", lambda s: s["base"])
    return found.select(
        "doc_id",
        *(F.size(pii.of_kind(base, k)).cast("long").alias(f"n_{k}") for k in pii.BASE),
        F.sha2(pii.listed(base, pii.BASE), 256).alias("base_sha256"),
        pii.listed(F.col("found")).alias("spans"),
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        sharding.text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    placed = sharding.assign(docs, key=["doc_id"], tie=["text_crc32", "size"], shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.OrdinalModel:
    labels = table(spark, sf_dir, "labels")
    ratings = labels.select("doc_id", quality.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    return quality.fit(docs, ratings, levels=3)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.with_quality(docs, quality_model(spark, docs, sf_dir)).drop("text")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "copies_id", "n_links")


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.piece_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests, capacity=2048)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs, tokenizer_file("piece_bpe_32k.model")).drop("text")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's law: of some documents all words from one on repeat the first few there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    planted = docs.withColumn("w", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(periodic_runs.WORD), F.lit(0))))
    planted = planted.withColumn("a", (g % F.greatest(F.size("w"), F.lit(1))).cast("int"))
    planted = planted.withColumn("p", (1 + F.floor((F.size("w") - F.col("a")) / (3 + g % 8))).cast("int"))
    tiled = F.array_join(periodic_runs.tiled(F.col("w"), F.col("a"), F.col("p")), " ")
    return planted.withColumn("text", F.when(F.size("w") > 0, tiled).otherwise(F.col("text"))).drop("w", "a", "p")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.with_runs(docs).withColumn("best", periodic_runs.strongest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(periodic_runs.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def kept_from_toxicity(doc_id) -> "F.Column":
    """Documents whose labels op12 must not learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~kept_from_toxicity("doc_id")))
    scored = toxicity.with_toxicity(docs, model, least=0.3)
    return scored.select("doc_id", kept_from_toxicity("doc_id").alias("held_out"), "score", "predicted", F.size("clauses").alias("n_clauses"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, top=2000, inside_percent=50)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language": op1_language,
        "op2_decontaminate": op2_decontaminate,
        "op3_pii": op3_pii,
        "op4_html_text": op4_html_text,
        "op5_shards": op5_shards,
        "op6_neighbours": op6_neighbours,
        "op7_quality": op7_quality,
        "op8_ngram_join": op8_ngram_join,
        "op9_pack": op9_pack,
        "op10_token_counts": op10_token_counts,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_toxicity": op12_toxicity,
        "op13_collocations": op13_collocations,
    }


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP2 = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 13) AS n,
         array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
lens AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT rid, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT dw.rid, dw.i, dw.n, win.item FROM dw JOIN win ON win.n = dw.n AND win.g = dw.g),
hw AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT rid, item FROM hits WHERE item IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hw.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(hi.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(hi.items, '')) AS items_sha256,
       coalesce(hw.n_hit, 0) > 0 AND 20 * coalesce(hw.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""


#: Exact neighbours. The operator's are exact too while a query asks all parts, as it does
#: of two parts (fewer than 3 x ``ann.PART_ROWS`` distinct vectors), so at the size at which
#: the SQL is compared; above that the operator is approximate and the SQL is not.
_OP6 = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND list_count(embedding) = len(embedding) AND isfinite(list_sum(CAST(embedding AS DOUBLE[])))
    AND (list_min(embedding) < 0 OR list_max(embedding) > 0)),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

_OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(len(w), 5) - 1), ' ') AS g
      FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y, k = nx.c AND k = ny.c AS equal FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
         WHERE 5 * k >= 4 * (nx.c + ny.c - k)),
reach(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
class AS (SELECT x, min(y) AS class_id FROM reach GROUP BY 1),
own AS (SELECT x, count(*) AS n_links, min(y) FILTER (WHERE equal) AS copy FROM link GROUP BY 1)
SELECT d.doc_id, class.class_id, least(d.doc_id, coalesce(own.copy, d.doc_id)) AS copies_id, CAST(coalesce(own.n_links, 0) AS BIGINT) AS n_links
FROM d JOIN class ON class.x = d.doc_id LEFT JOIN own ON own.x = d.doc_id
"""

_OP13 = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (SELECT lang, k, w[i:i + k - 1] AS g
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cut AS (SELECT c.lang, c.k, c.g, c.f AS a, unnest(range(1, c.k)) AS j FROM c),
val AS (SELECT cut.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
        FROM cut JOIN f x ON x.lang = cut.lang AND x.g = cut.g[1:j] JOIN f y ON y.lang = cut.lang AND y.g = cut.g[j + 1:]),
low AS (SELECT * FROM val QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
long AS (SELECT lang, unnest([g[1:2], g[2:3]]) AS g, f FROM c WHERE k = 3),
ins AS (SELECT lang, g, max(f) AS most FROM long GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN ins USING (lang, g) WHERE most IS NULL OR 100 * most < 50 * a),
txt AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM kept),
rk AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM txt)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM rk JOIN n USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": _OP2, "op6_neighbours": _OP6, "op8_ngram_join": _OP8, "op13_collocations": _OP13}
