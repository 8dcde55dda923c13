"""Registered queries of the operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm import ship_package
from daymark.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daymark.llm.tokens import ids_crc32, read_token_files, write_token_files

    path = shared_dir(spark, "op6")
    write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"))
    return ids_crc32(read_token_files(spark, path))


@_query("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding gives the text back.

    A text that holds the mark character itself decodes to a space there.
    """
    from daymark.llm.sentencepiece import encode_documents, load_model

    model = load_model(tokenizer_file("piece_bpe_32k.model"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode_documents(docs, model, decoded_col="decoded")
    return both.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        "piece_ids",
        F.crc32("decoded").alias("decoded_crc32"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@_query("op1_mix_sources")
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daymark.llm.mix import mix_sources

    mixed = mix_sources(_table(spark, sf_dir, "documents")).documents
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


# The level of the water-filling is found by trying each source, in order of
# cap by weight, as the last that is capped.
ORACLE_SQL["op1_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM d GROUP BY source),
w AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
r AS (
  SELECT *, coalesce(sum(2 * source_size) OVER o, 0) AS full_before,
         sum(weight) OVER (ORDER BY 2.0 * source_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_from,
         1.5 * sum(source_size) OVER () AS budget
  FROM w WINDOW o AS (ORDER BY 2.0 * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (
  SELECT (budget - full_before) / open_from AS level FROM r
  WHERE 2.0 * source_size / weight > (budget - full_before) / open_from
  ORDER BY 2.0 * source_size / weight, place LIMIT 1),
t AS (SELECT r.*, least(CAST(2 * source_size AS DOUBLE), coalesce(level, 0) * weight) AS target FROM r LEFT JOIN lv ON true),
c AS (
  SELECT d.*, t.source_size, t.place, t.target, t.budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size) AS sent
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT c.*, epoch, (source_size * (epoch - 1) + sent) / target AS finish
  FROM c, (VALUES (1), (2)) v(epoch) WHERE target > 0),
p AS (
  SELECT *, sum(size) OVER (ORDER BY finish, place, epoch, sent, k ROWS UNBOUNDED PRECEDING) AS position FROM e),
n AS (SELECT doc_id, count(*) AS copies FROM p WHERE position <= budget GROUP BY doc_id)
SELECT c.doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(coalesce(copies, 0) * size AS BIGINT) AS taken
FROM c LEFT JOIN n USING (doc_id)
"""


@_query("op5_shard_bytes")
def op5_shard_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daymark.llm.shards import shard_documents

    sharded = shard_documents(_table(spark, sf_dir, "documents"))
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daymark.llm.jaccard import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"))


# Sets are compared as classes of equal sets; a pair of similarity 0.8 shares
# one of the rarest n - ceil(0.8 n) + 1 shingles of each set.
ORACLE_SQL["op3_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')) END)) AS sh
  FROM w),
c AS (SELECT min(doc_id) AS c, sh, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh),
t AS (SELECT c, n, unnest(sh) AS x FROM c),
f AS (SELECT *, count(*) OVER (PARTITION BY x) AS df FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY df, x) AS place FROM f),
p AS (SELECT c, n, x FROM r WHERE place <= n - (80 * n + 99) // 100 + 1 AND df > 1),
q AS (SELECT DISTINCT a.c AS a, b.c AS b FROM p a JOIN p b ON a.x = b.x AND a.c < b.c AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
v AS (SELECT q.a, q.b, len(list_intersect(x.sh, y.sh)) AS i, x.n + y.n AS n FROM q JOIN c x ON x.c = q.a JOIN c y ON y.c = q.b),
l AS (SELECT a, b FROM v WHERE 100 * i >= 80 * (n - i)),
g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
k AS (SELECT c AS node, c AS root FROM c UNION SELECT g.b, k.root FROM k JOIN g ON g.a = k.node WHERE k.root < g.b),
m AS (SELECT node, min(root) AS root FROM k GROUP BY node)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(m.root, s.doc_id) AS component_id
FROM s LEFT JOIN c ON s.sh = c.sh LEFT JOIN m ON m.node = c.c
"""


@_query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daymark.llm.labelled import in_fold, labelled_sample
    from daymark.llm.toxicity import fit_toxicity, score_toxicity

    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = in_fold(F.col("doc_id"), 4, 2)
    model = fit_toxicity(labelled_sample(docs.select("doc_id", "text"), labels, "toxic", ~held_out, 5000))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daymark.llm.labelled import in_fold, labelled_sample
    from daymark.llm.quality import fit_quality, score_quality

    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = fit_quality(labelled_sample(docs.select("doc_id", "text"), labels, "quality", ~held_out, 3000))
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query("op9_neighbours")
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daymark.llm.neighbours import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query("op8_merkle_fingerprint")
def op8_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daymark.llm.merkle import edit_likeness

    return edit_likeness(_table(spark, sf_dir, "documents"))


_MERKLE_TREE = r"""
    list_transform(string_split({0}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p: {{
      'd': sha256('p' || p),
      'r': list_transform(regexp_extract_all(p, '[ \t\x0B\f\r]*(?:[^ \t\x0B\f\r]+[ \t\x0B\f\r]*){{1,4}}|[ \t\x0B\f\r]+'), lambda x: left(md5(x), 6))}}))"""
_MERKLE_SECTION = "sha256('s' || array_to_string(list_transform(s, lambda p: p.d), ''))"
_MERKLE_PRINT = f"""
    left(sha256('r' || array_to_string(list_transform({{0}}, lambda s: {_MERKLE_SECTION}), '')), 32) || '/' ||
    array_to_string(list_transform({{0}}, lambda s: left({_MERKLE_SECTION}, 8) || ':' ||
      array_to_string(list_transform(s, lambda p: left(p.d, 8) || '-' || array_to_string(p.r, '')), ',')), '/')"""
_MERKLE_RUNS = "list_distinct(flatten(list_transform({0}, lambda s: flatten(list_transform(s, lambda p: p.r)))))"
_MERKLE_ALIKE = "CASE WHEN left({0}, 32) = left({1}, 32) OR len({2}) + len({3}) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect({2}, {3})) / (len({2}) + len({3})) END"
ORACLE_SQL["op8_merkle_fingerprint"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n FROM documents),
o AS (SELECT *, coalesce(lead(doc_id) OVER (ORDER BY doc_id), min(doc_id) OVER ()) AS next_id FROM d),
e AS (SELECT o.*, left(o.text, CAST(o.n - o.n // 4 AS BIGINT)) || left(x.text, CAST(o.n // 4 AS BIGINT)) AS edited
      FROM o JOIN d x ON x.doc_id = o.next_id),
t AS (SELECT *, {_MERKLE_TREE.format("text")} AS t, {_MERKLE_TREE.format("edited")} AS et FROM e),
p AS (SELECT *, {_MERKLE_PRINT.format("t")} AS f, {_MERKLE_PRINT.format("et")} AS ef, {_MERKLE_RUNS.format("t")} AS r, {_MERKLE_RUNS.format("et")} AS er FROM t)
SELECT p.doc_id, p.n AS n_chars, sha256(p.edited) AS edited_sha256, p.f AS fingerprint, p.ef AS edited_fingerprint,
  {_MERKLE_ALIKE.format("p.f", "p.ef", "p.r", "p.er")} AS near_edited, {_MERKLE_ALIKE.format("p.f", "x.f", "p.r", "x.r")} AS near_next
FROM p JOIN p x ON x.doc_id = p.next_id
"""


@_query("op4_sentence_spans")
def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's text without repeated passages, and what went."""
    from daymark.llm.spans import remove_repeated_passages

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_passages(docs, local_cuts=True, both_sides=True).select("doc_id", "text", "n_sentences", "n_removed", "removed")


@_query("op13_merkle_manifest")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daymark.llm.manifest import ascii_lower, digest, document_leaf, fold, proofs, siblings, write_manifest

    docs = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.when(tampered, document_leaf(ascii_lower(F.col("text"))))
    manifest = write_manifest(docs, shared_dir(spark, "op13"), leaf=document_leaf(F.col("text")), keep={"changed": changed})
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    proved = proofs(spark, manifest).select(
        F.col("ident").alias("doc_id"),
        "leaf",
        "subroot",
        F.lit(manifest.root).alias("root"),
        digest(siblings(F.col("path"))).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _FIELD + ")"
_LOWER_AZ = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TREE = """
  SELECT {key}, 0 AS level, list(node ORDER BY place) AS nodes FROM {src} GROUP BY {key}
  UNION ALL
  SELECT {key}, level + 1, list_transform(range(0, len(nodes), 16), lambda i: sha256(array_to_string(nodes[i + 1:i + 16], '')))
  FROM {name} WHERE len(nodes) > 1"""
# DuckDB has no CRC-32, so the table of its 256 steps is built by a recursion over eight shifts.
ORACLE_SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE z AS (
  SELECT i, i AS v, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END, k + 1 FROM z WHERE k < 8),
zt AS (SELECT list(v ORDER BY i) AS t FROM z WHERE k = 8),
d AS (
  SELECT doc_id, source, {_LEAF.format("text")} AS node, {_LEAF.format(_LOWER_AZ)} AS lowered,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
             lambda a, c: xor(a >> 8, t[xor(a & 255, c) + 1])), 4294967295) % 5 = 0 AS tampered
  FROM documents, zt),
e AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, node) - 1 AS place FROM d),
l AS ({_TREE.format(key="source", src="e", name="l")}),
s AS (
  SELECT source, nodes[1] AS node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, 0 AS g
  FROM l WHERE len(nodes) = 1),
u AS ({_TREE.format(key="g", src="s", name="u")}),
r AS (SELECT nodes[1] AS root FROM u WHERE len(nodes) = 1),
n AS (
  SELECT source, place, level, nodes[(place // 16) * 16 + 1:(place // 16) * 16 + 16] AS run, place % 16 AS own, seq FROM (
    SELECT e.source, e.place AS seq, CAST(floor(e.place / power(16, level)) AS BIGINT) AS place, level, nodes
    FROM e JOIN l ON e.source IS NOT DISTINCT FROM l.source WHERE len(nodes) > 1
    UNION ALL
    SELECT e.source, e.place, CAST(floor(s.place / power(16, u.level)) AS BIGINT), 1000 + u.level, u.nodes
    FROM e JOIN s ON e.source IS NOT DISTINCT FROM s.source JOIN u ON true WHERE len(u.nodes) > 1)),
p AS (
  SELECT source, seq, list({{'a': array_to_string(run[1:own], ''), 'b': array_to_string(run[own + 2:16], '')}} ORDER BY level) AS path
  FROM n GROUP BY source, seq),
f AS (
  SELECT e.doc_id, e.node AS leaf, s.node AS subroot, r.root, coalesce(p.path, []) AS path, CASE WHEN tampered THEN lowered ELSE e.node END AS start
  FROM e JOIN s ON e.source IS NOT DISTINCT FROM s.source CROSS JOIN r
  LEFT JOIN p ON e.source IS NOT DISTINCT FROM p.source AND e.place = p.seq),
x AS (
  SELECT *, list_reduce(list_prepend({{'a': '', 'b': start}}, path), lambda x, y: {{'a': '', 'b': sha256(y.a || x.b || y.b)}}).b AS folded_root FROM f)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda q: q.a || q.b), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM x
"""


@_query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daymark.llm.whitening import fit_whitening, identity_error, whiten

    vectors = _table(spark, sf_dir, "embeddings")
    model = fit_whitening(vectors)
    error = identity_error(vectors, model)
    shares = F.array(*[F.lit(float(v)) for v in model.explained]).cast("array<double>")
    return whiten(vectors, model).select(
        "vec_id",
        "component",
        F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        "whitened",
        F.element_at(shares, F.col("component")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


@_query("op12_language")
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daymark.llm.labelled import in_fold
    from daymark.llm.language import fit_language, label_documents, language_sample

    docs = _table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    model = fit_language(language_sample(docs.select("doc_id", "text", "lang"), ~held_out))
    labelled = label_documents(docs.select("doc_id", "text"), model, runs_col="runs")
    return labelled.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "runs")
