"""One query per operator over its whole table, with production parameters, and the SQL it must equal."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse.llm import alignment, bpe, chat, embedding_join, fingerprints, jaccard_join, licenses, mixing, quality, sharding, spelling, tokens, toxicity
from zonepulse.llm.text import words
from zonepulse.session import materialize, scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; the folder is the installed package's."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _license_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in licenses.TEMPLATES)
    words = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-/:-@\[-`{-\x7F]+'), lambda x: x <> '')"
    k, part, match = licenses.SHINGLE, licenses.PART, licenses.MATCH
    shingles = f"unnest(range(len(w) - {k - 1})) AS pos"
    shingle = " || ' ' || ".join(f"w[pos + {i + 1}]" for i in range(k))
    return f"""
WITH template(license, text) AS (VALUES {rows}),
parts AS (SELECT DISTINCT license, pos // {part} AS part, {shingle} AS s FROM
          (SELECT license, w, {shingles} FROM (SELECT license, {words} AS w FROM template))),
sized AS (SELECT license, part, count(*) AS n, CAST(pow(2, ceil(log2(count(*)))) AS BIGINT) AS c FROM parts GROUP BY ALL),
totals AS (SELECT license, sum(n) AS total FROM sized GROUP BY license),
doc AS (SELECT doc_id, pos, {shingle} AS s FROM
        (SELECT doc_id, w, {shingles} FROM (SELECT doc_id, {words} AS w FROM documents))),
hit AS (SELECT doc_id, license, part, n, c, s, pos FROM doc JOIN parts USING (s) JOIN sized USING (license, part)),
win AS (SELECT doc_id, license, part, n, greatest(pos // c - back, 0) * c AS start, count(DISTINCT s) AS found
        FROM hit, (VALUES (0), (1)) AS b(back) GROUP BY ALL),
best AS (SELECT doc_id, license, part, max(found) AS found, arg_min(start, (-found, start)) AS start
         FROM win WHERE found >= {match} * n GROUP BY ALL)
SELECT doc_id, license, CAST(sum(found) AS DOUBLE) / max(total) AS containment, arg_min(start, part) AS window_start
FROM best JOIN totals USING (license) GROUP BY ALL HAVING sum(found) / max(total) >= {match}"""


ORACLES["op1_license_scan"] = _license_sql()


@query
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model, keep_text=False).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_token_output(spark, sf_dir):
    path = scratch_dir(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return tokens.with_crc32(tokens.read_tokens(spark, path, "doc_id", "n_tokens", "ids")).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


SOURCE_WEIGHTS = (5.0, 2.0, 1.0)


def source_weights(names):
    return [SOURCE_WEIGHTS[i % len(SOURCE_WEIGHTS)] for i in range(len(names))]


@query
def op4_source_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.size(words(F.col("text"))).cast("bigint").alias("size"))
    sized = materialize(docs, "sizes")
    mixed, targets, sizes = mixing.mix(sized, F.array("source"), "size", source_weights)
    by_source = spark.createDataFrame([(s, int(n), float(targets[s])) for s, n in sizes.items()],
                                      "_source string, source_size bigint, target double")
    return mixed.join(F.broadcast(by_source), F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


@query
def op5_byte_bpe(spark, sf_dir):
    ranks = vocabulary(BPE_RANKS)
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks)
    return bpe.decode(coded.withColumn("n_tokens", F.size("ids").cast("bigint")), ranks, id_bytes="id_bytes").select(
        "doc_id", "n_tokens", F.sha2("id_bytes", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


PLANTED = r"\### Assistant: </turn> ok"


@query
def op6_chat_format(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], given.schema)
    written = materialize(chat.format_turns(given.unionByName(planted)), "chat")
    return chat.digests(written, "conv_id", ("turn", "formatted"))


@query
def op7_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join.link_components(table(spark, sf_dir, "documents"))


@query
def op8_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs).drop("lang")


@query
def op9_document_fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.length("text")
    pairs = fingerprints.sketch(fingerprints.with_next(docs), "text", "own").withColumn(
        "edited", F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))"),
                           "next_start"))
    both = fingerprints.sketch(pairs, "edited", "edited_sketch")
    return both.select(
        "doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("own")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("own"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("own"), F.col("next_sketch")).alias("near_next"))


SHARDS = 24


@query
def op10_sharding(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    light = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.shard_rows(light, SHARDS, "doc_id", "text_crc32", "size").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op11_spelling_variants(spark, sf_dir):
    words = spelling.word_counts(table(spark, sf_dir, "documents"), edit_one_in=spelling.EDIT_ONE_IN)
    return spelling.spelling_forms(words)


ORACLES["op11_spelling_variants"] = r"""
WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))),
run AS (SELECT doc_id, r, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents) GROUP BY ALL),
bytes AS (SELECT r, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b FROM run),
hashed AS (SELECT r, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(b, lambda x: CAST(x AS BIGINT))),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h FROM bytes, crc),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 199 = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2)
    ELSE r END AS word FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gaps AS (SELECT word, n, i, left(word, i) || '*' || substr(word, i + 2) AS gap, left(word, i) || substr(word, i + 2) AS rest
       FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
one AS (SELECT a.word, b.word AS near, b.n FROM gaps a JOIN gaps b ON a.i = b.i AND a.gap = b.gap AND a.word <> b.word
        UNION SELECT g.word, w.word, w.n FROM gaps g JOIN w ON g.rest = w.word
        UNION SELECT w.word, g.word, g.n FROM gaps g JOIN w ON g.rest = w.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS most FROM one GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN near END AS form,
      CASE WHEN most >= 5 * w.n THEN most END AS form_n FROM w LEFT JOIN best ON best.word = w.word),
way(word, here) AS (SELECT word, word FROM f UNION ALL SELECT way.word, f.form FROM way JOIN f ON f.word = here WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.here AS root, f.n, f.n_near, f.form_n FROM f JOIN way ON way.word = f.word
JOIN f AS stop ON stop.word = way.here WHERE stop.form IS NULL"""


@query
def op12_token_alignment(spark, sf_dir):
    return alignment.link_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query
def op13_embedding_join(spark, sf_dir):
    return embedding_join.link_near(table(spark, sf_dir, "embeddings"))


ORACLES["op13_embedding_join"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, row_number() OVER () AS r FROM embeddings),
fine AS (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x <> 0)) > 0
         AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
link AS (SELECT a.r AS a, b.r AS b, b.vec_id AS other FROM fine a JOIN fine b ON a.label = b.label AND a.r <> b.r
         AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT r, r FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN v ON v.r = b GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = r) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON a = r"""

ORACLES["op6_chat_format"] = r"""
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (SELECT *, length('### ' || role || ': ' || text || chr(10) || '</turn>' || chr(10))
  + len(regexp_extract_all(text, '### [^\s:]{0,64}: |</turn>')) AS chars FROM given)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""

ORACLES["op7_ngram_jaccard_join"] = r"""
WITH RECURSIVE split AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 5], ' ') AS s FROM (
    SELECT doc_id, w, unnest(range(greatest(len(w) - 4, least(len(w), 1)))) AS i FROM split)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_have JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id"""
