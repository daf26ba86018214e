"""The package's registered queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from kestrel.llm import (centroids, chat_format, curve_packing, decontam, divergence, langid, licenses, llr_quality, minhash, rlz_dedup,
                         suffix_dedup, token_files, toxicity)
from kestrel.llm.common import ship, table, text_id

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    """Register f under its name; its package reaches the executors before it runs."""
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rlz_dedup.parse(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))



@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "coverage", "n_tiles", "longest", "item_tokens")


@query
def op4_llr_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = llr_quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), toward_raw=llr_quality.TOWARD_RAW)
    return out.withColumnRenamed("id", "doc_id")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.predict(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(text_id("id") == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.groups(table(spark, sf_dir, "documents"), percent=85)
    return out.withColumnRenamed("id", "doc_id")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(text_id("id") == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op7_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.pack(table(spark, sf_dir, "documents")).drop("ids")


@query
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql("""select * from values (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')
                         as t(conv_id, turn, role, text)""")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chat_format.read_back(chat_format.windows(turns))
    return out.select(F.col("conv").alias("conv_id"), "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
                      F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                      F.col("formatted_chars").cast("bigint").alias("formatted_chars"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("found").withColumnRenamed("id", "doc_id").withColumn("score", F.round("score", 6))


@query
def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.fresh_path(spark)
    token_files.write(table(spark, sf_dir, "documents"), path)
    return token_files.documents(token_files.shards(spark, path))


@query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings")))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op9_minhash_near_dedup"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT w.doc_id, count(sh.s) AS n FROM w LEFT JOIN sh USING (doc_id) GROUP BY w.doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.y FROM reach JOIN links ON links.x = reach.b)
SELECT n.doc_id, n.n AS n_shingles, min(reach.b) AS component_id, n.doc_id = min(reach.b) AS kept
FROM n JOIN reach ON reach.a = n.doc_id GROUP BY n.doc_id, n.n"""

ORACLES["op10_substring_dedup"] = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
starts AS (SELECT doc_id, i, row_number() OVER (PARTITION BY md5(array_to_string(ws[i:i + 19], ' ')) ORDER BY doc_id, i) AS nth
           FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w) x),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM starts, range(0, 20) r(j) WHERE nth > 1),
k AS (SELECT t.doc_id, count(*) AS n_words, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY t.i) FILTER (WHERE gone.i IS NULL) AS kept
      FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.i = t.i GROUP BY t.doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)"""


def _escaped_sql(col: str, lines: bool = False) -> str:
    out = f"replace({col}, '\\', '\\e')"
    for word in chat_format.CONTROL:
        out = f"replace({out}, '{word}', '{chr(92)}{'l' if word[0] == '<' else 'b'}{word[1:]}')"
    return f"replace({out}, chr(10), '\\n')" if lines else out


ORACLES["op2_chat_formatting"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (SELECT *, len(regexp_extract_all(text, '\\w+|[^\\w\\s\\x0B]')) + {chat_format.MARKERS} AS tokens,
             {len(chat_format.START) + len(chat_format.STOP) + 2} + length({_escaped_sql('role', True)}) + length({_escaped_sql('text')}) AS size FROM t),
o AS (SELECT *, row_number() OVER w AS place, sum(tokens) OVER (w ROWS UNBOUNDED PRECEDING) AS upto, count(*) OVER (PARTITION BY conv_id) AS n
      FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (SELECT conv_id, tokens, size FROM o WHERE place = 1 AND role = 'system' AND n > 1),
b AS (SELECT o.conv_id, o.size, o.upto - coalesce(s.tokens, 0) - o.tokens AS a, o.upto - coalesce(s.tokens, 0) AS z, coalesce(s.size, 0) AS system,
             greatest({chat_format.BUDGET - chat_format.HISTORY} - coalesce(s.tokens, 0), {chat_format.LEAST_BODY}) AS stretch
      FROM o LEFT JOIN s USING (conv_id) WHERE s.conv_id IS NULL OR o.place > 1),
h AS (SELECT *, a // stretch AS home, (z - 1) // stretch > a // stretch AS crosses FROM b),
spans AS (SELECT conv_id, home, crosses, min(a) AS begin, any_value(system) + sum(size) AS size FROM h GROUP BY conv_id, home, crosses),
chars AS (SELECT conv_id, sum(size) + sum((SELECT coalesce(sum(h.size), 0) FROM h WHERE h.conv_id = spans.conv_id AND h.z <= spans.begin AND h.a >= spans.begin - {chat_format.HISTORY})) AS formatted_chars
          FROM spans GROUP BY conv_id),
d AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS said,
             coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS loss FROM o GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM d JOIN chars USING (conv_id)"""

_PHRASES = (*licenses.BASE, *licenses.FURTHER)
_LICENCE_WORDS = licenses.vocabulary(_PHRASES)


def _places_sql(phrase: str) -> str:
    words = phrase.split()
    listed = ", ".join(f"'{w}'" for w in words)
    return f"list_filter(range(0, greatest(len(ws) - {len(words) - 1}, 0)), lambda i: ws[i + 1:i + {len(words)}] = [{listed}])"


ORACLES["op5_license_scan"] = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
idf AS (SELECT {', '.join(f"ln((count(*) + 1) / (count_if(list_contains(ws, '{v}')) + 1)) AS i_{v}" for v in _LICENCE_WORDS)} FROM w),
m AS (SELECT {', '.join(' + '.join(f'i_{v}' for v in sorted(set(p.split()))) + f' AS m{k}' for k, (p, _) in enumerate(_PHRASES))} FROM idf),
f AS (SELECT doc_id, len(ws) AS n, {', '.join(f'{_places_sql(p)} AS p{k}' for k, (p, _) in enumerate(_PHRASES))} FROM w),
g AS (SELECT *, {' || '.join(f'p{k}' for k in range(len(licenses.BASE)))} AS starts FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(starts) AS BIGINT) AS n_base, list_min(starts) AS first_word, list_max(starts) AS last_word,
       array_to_string(list_sort(list_distinct([{', '.join(f"CASE WHEN len(p{k}) > 0 THEN '{l}' END" for k, (_, l) in enumerate(licenses.BASE))}])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct([{', '.join(f"CASE WHEN len(p{k}) > 0 THEN '{l}' END" for k, (_, l) in enumerate(_PHRASES))}])), ',') AS labels,
       round(coalesce(greatest({', '.join(f'CASE WHEN len(p{k}) > 0 THEN m{k} END' for k in range(len(_PHRASES)))}), 0) / greatest({', '.join(f'm{k}' for k in range(len(_PHRASES)))}, 1e-9), 6) AS score
FROM g, m"""


ORACLES["op11_divergence_audit"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= {divergence.MIN_DOCUMENTS}),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY 1),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             CAST(1 + ({divergence.SCALE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.n, 0) + v.v) AS BIGINT) AS p,
             CAST(1 + ({divergence.SCALE}::HUGEINT * (k.n + 1)) // (v.n + v.v) AS BIGINT) AS q
      FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= {divergence.RANKS}"""


def _clustering_sql() -> str:
    """Each round as its own steps: nearest centroid of every vector, floored means of every cluster."""
    steps = [f"""x AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
      WHERE len(embedding) = {centroids.COMPONENTS} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {centroids.COMPONENTS}),
e AS MATERIALIZED (SELECT r, vec_id, i, CAST(floor({centroids.SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS v FROM x, range(1, {centroids.COMPONENTS + 1}) t(i)),
s AS (SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k FROM x QUALIFY k < {centroids.CENTROIDS}),
c0 AS MATERIALIZED (SELECT k, i, v FROM s JOIN e USING (r))"""]
    for n in range(centroids.ROUNDS + 1):
        steps.append(f"""d{n} AS (SELECT r, k, sum((e.v - c.v) * (e.v - c.v)) AS d FROM e JOIN c{n} c USING (i) GROUP BY r, k),
a{n} AS MATERIALIZED (SELECT r, k, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)""")
        if n < centroids.ROUNDS:
            steps.append(f"""m{n} AS (SELECT k, i, CAST(sum(v) AS HUGEINT) AS s, count(*) AS n FROM a{n} JOIN e USING (r) GROUP BY k, i),
c{n + 1} AS MATERIALIZED (SELECT c.k, c.i, CAST(coalesce((s - ((s % n) + n) % n) // n, v) AS BIGINT) AS v FROM c{n} c LEFT JOIN m{n} m ON m.k = c.k AND m.i = c.i)""")
    n = centroids.ROUNDS
    return "WITH " + ",\n".join(steps) + f"""
SELECT x.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{n} a JOIN x USING (r) JOIN (SELECT k, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{n} GROUP BY k) h ON h.k = a.k"""


ORACLES["op13_centroid_clustering"] = _clustering_sql()
