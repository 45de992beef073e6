"""Registered queries of the subpackage: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytededup, chat, decontam, linededup, lm, neardup, packing, quality, secrets, spelling, topk, toxicity, whitening
from .common import fold, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, fold(F.col("doc_id"), 5) != 0)
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "words", "mean_log_ratio")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(secrets.labelled_samples(docs)))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.concat("base", "markov")).alias("spans"),
        F.size("markov").cast("long").alias("n_markov"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, fold(F.col("doc_id"), 4) != 2)
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return quality.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.kept_lines(docs)
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1))
    return out.select(
        "doc_id", lines.cast("long").alias("n_lines"),
        F.coalesce(lines - F.size("kept"), F.lit(0)).cast("long").alias("removed_lines"),
        F.coalesce(F.array_join("kept", "\n"), "text").alias("text"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) == 2)


PLANTED = (-7, r"\### Assistant: </turn> ok")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    conv, said = PLANTED
    extra = spark.range(2).select(F.lit(conv).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(said).alias("text"))
    # each row is an event that starts a message of its own
    place = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    one = rows.unionByName(extra).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    events = one.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"),
                        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
                        place.alias("place"), "role", "text")
    events = events.select("conv_id", "seq", "kind", F.struct("place", "copy").alias("target"), "role", "text")
    out = chat.render(chat.reconstruct(events))
    out = out.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("parsed"),
                     chat.loss_text(F.col("turns")).alias("loss"))
    digest = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("parsed").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, default_vocabulary()), docs.count())


def op11_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bytededup.cut_repeats(docs, keep=["doc_id"])
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return out.select(
        "doc_id", (F.length("kept") + gone).alias("n_bytes"), gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, components=16).drop("embedding")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"))
    return spelling.variants(words)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality": op3_quality,
    "op4_topk_search": op4_topk_search,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_lm_score": op8_lm_score,
    "op9_chat_format": op9_chat_format,
    "op10_packing": op10_packing,
    "op11_byte_dedup": op11_byte_dedup,
    "op12_whitening": op12_whitening,
    "op13_spelling": op13_spelling,
}

SQL: dict[str, str] = {
    "op4_topk_search": """
WITH v AS (
    SELECT CAST(vec_id AS BIGINT) AS vec_id,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
    SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op5_minhash_dedup": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(COALESCE(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) < 2 THEN w
           ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
    FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 80 * (a.n + b.n - COUNT(*))
), sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, l.b FROM reach r JOIN sides l ON r.b = l.a
), least AS (SELECT a, MIN(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON a = doc_id""",
    # every diagonal of equal lines with an earlier place, cut into unbroken runs
    "op6_line_dedup": r"""
WITH split AS (SELECT doc_id, text, string_split(COALESCE(text, ''), chr(10)) AS s FROM documents
), lines AS (
    SELECT doc_id, pos, line, len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
    FROM (SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS pos FROM split)
), pairs AS (
    SELECT x.doc_id, y.doc_id AS other, x.pos - y.pos AS diagonal, x.pos, x.n
    FROM lines x JOIN lines y ON x.line = y.line
     AND (y.doc_id < x.doc_id OR (y.doc_id = x.doc_id AND y.pos < x.pos))
), numbered AS (
    SELECT *, pos - ROW_NUMBER() OVER (PARTITION BY doc_id, other, diagonal ORDER BY pos) AS run FROM pairs
), runs AS (
    SELECT doc_id, MIN(pos) AS lo, MAX(pos) AS hi FROM numbered
    GROUP BY doc_id, other, diagonal, run HAVING SUM(n) >= 25
), gone AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS pos FROM runs
), kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS rest
    FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
), removed AS (SELECT doc_id, COUNT(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_lines, COALESCE(removed.n, 0) AS removed_lines,
       CASE WHEN removed.n IS NULL THEN text ELSE COALESCE(rest, '') END AS text
FROM split LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op9_chat_format": r"""
WITH rows AS (
    SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn,
           COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *, replace(replace(replace(text, '\', '\b'), '<', '\l'), '##', '\h#') AS body,
           CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
                ELSE 2 + length(replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '##', '\h#'), ':', '\c'))
           END + 6 + 8 AS marks
    FROM rows)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(COALESCE(SUM(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(marks + length(body)) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    # CRC-32 by its table, near words by the neighbourhood of single deletions
    "op13_spelling": r"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
               CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t
), runs AS (
    SELECT doc_id, run, COUNT(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
    WHERE length(run) >= 7 GROUP BY doc_id, run
), coded AS (
    SELECT run, n, hex(doc_id || ':' || run) AS code FROM runs
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
               list_transform(range(0, length(code), 2), lambda i: ('0x' || code[i + 1:i + 2])::BIGINT),
               lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295)) AS h
    FROM coded, crc
), words AS (
    SELECT word, CAST(SUM(n) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING SUM(n) >= 2
), cut AS (
    SELECT word, unnest(range(length(word))) AS at, unnest(list_transform(range(length(word)),
               lambda i: word[:i] || word[i + 2:])) AS rest FROM words
), near AS (
    SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.at = b.at AND a.word <> b.word
    UNION SELECT cut.word, words.word FROM cut JOIN words ON cut.rest = words.word
    UNION SELECT words.word, cut.word FROM cut JOIN words ON cut.rest = words.word
), best AS (
    SELECT near.word, COUNT(*) AS n_near, MAX(o.n) AS most FROM near JOIN words o ON o.word = near.other GROUP BY near.word
), forms AS (
    SELECT w.word, MIN(o.word) AS form, MAX(o.n) AS form_n
    FROM words w JOIN best USING (word) JOIN near USING (word) JOIN words o ON o.word = near.other AND o.n = best.most
    WHERE best.most >= 10 * w.n GROUP BY w.word
), steps AS (
    SELECT word, word AS root FROM words UNION ALL
    SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.root
)
SELECT word, form, root, n, COALESCE(n_near, 0) AS n_near, form_n
FROM words LEFT JOIN best USING (word) LEFT JOIN forms USING (word)
JOIN (SELECT * FROM steps ANTI JOIN (SELECT word AS root FROM forms) USING (root)) USING (word)""",
}
