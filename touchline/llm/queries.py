"""The numbered operators as queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.llm import bins, conversations, embeddings, licenses, lines, mixing, packing, secrets, simhash, suffix_tree, syncmers, toxicity, whitening


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Weights 5, 2, 1 over the sources, 150 % of all words, no source above twice its size."""
    docs = _table(spark, folder, "documents")
    return mixing.taken_words(mixing.mix(docs, mixing.cyclic_weights((5, 2, 1)), share=1.5, most=2))


def op2_embedding_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of equal label with a cosine of at least 0.93, and the groups they form."""
    return embeddings.near_duplicates(_table(spark, folder, "embeddings"), 0.93)


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reached(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT links.b, reached.other FROM reached JOIN links ON reached.id = links.a),
least AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = id LEFT JOIN counts ON vec_id = a"""


def op3_simhash_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash over 3-word shingles; fingerprints that differ in 3 bits or fewer are linked."""
    found = simhash.near_duplicates(_table(spark, folder, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", simhash.as_hex("key").alias("fingerprint"), "component_id")


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, found through a trigram index."""
    return secrets.digest(secrets.scan(_table(spark, folder, "documents").select("doc_id", "text")))


# Kind, expression and least length of the match or, for assign, of what follows the sign; letters of either case spelled out.
_SECRET_KINDS = [
    ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))""", 6),
    ("access", r"(AKIA[A-Z0-9]+)()", 20),
    ("hex", r"([0-9a-f]+)()", 24),
    ("github", r"(gh[pousr]_[A-Za-z0-9]+)()", 40),
    ("google", r"(AIza[0-9A-Za-z_-]+)()", 39),
    ("slack", r"(xox[abprs]-[0-9A-Za-z-]+)()", 20),
    ("stripe", r"((?:sk|rk)_live_[0-9A-Za-z]+)()", 24),
    ("private_key", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)()", 0),
    ("web_token", r"(eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)()", 40),
]
OP4_SQL = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), chr(1) || chr(3), chr(2) || chr(2)) AS t FROM documents),
marked AS (""" + " UNION ALL ".join(
    f"SELECT r, {n} AS k, '{kind}' AS kind, {least} AS least, string_split(regexp_replace(t, '{pattern}', chr(1) || '\\1' || chr(3) || '\\2' || chr(1), 'g'), chr(1)) AS parts FROM texts"
    for n, (kind, pattern, least) in enumerate(_SECRET_KINDS)
) + """),
pieces AS (SELECT r, k, kind, least, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM marked WHERE len(parts) > 1),
sized AS (SELECT *, length(split_part(part, chr(3), 1)) AS n, length(split_part(part, chr(3), 2)) AS inner_n FROM pieces),
placed AS (SELECT *, sum(n) OVER (PARTITION BY r, k ORDER BY pos) - n AS s FROM sized),
spans AS (SELECT r, k, kind, s, kind || ':' || s || ':' || (s + n) AS span FROM placed WHERE pos % 2 = 0 AND CASE WHEN k = 0 THEN inner_n ELSE n END >= least),
found AS (SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(span, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg(span, ',' ORDER BY s, k) AS spans FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (r)"""


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Mentions of licences and licence notices in every document."""
    return licenses.scan(_table(spark, folder, "documents").select("doc_id", "text"))


def _quoted(text: str) -> str:
    return "'" + " ".join(text.split()).replace("'", "''") + "'"


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP5_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS ws FROM documents),
words AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM texts),
runs AS (SELECT r, p, w, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY r ORDER BY p)),
places AS (SELECT r, p, CASE WHEN w = 'gnu' AND w1 = 'general' AND w2 = 'public' AND w3 = 'license' THEN 'gpl' WHEN w = 'apache' AND w1 = 'license' THEN 'apache'
  WHEN w = 'cc' AND w1 = 'by' THEN 'cc-by' WHEN w = 'mit' AND w1 = 'license' THEN 'mit' END AS label FROM runs),
base AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places WHERE label IS NOT NULL GROUP BY r),
notices(i, label, key, text) AS (VALUES {", ".join(f"({i}, {_quoted(label)}, {_quoted(key)}, {_quoted(text)})" for i, (label, key, text) in enumerate(licenses.TEMPLATES))}),
own AS (SELECT i, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS q FROM (SELECT i, regexp_extract_all(lower(text), '{_WORDS}') AS ws FROM notices)),
held AS (SELECT w, count(DISTINCT r) AS n FROM words WHERE w IN (SELECT w FROM own) GROUP BY w),
rare AS (SELECT w, n FROM held WHERE n * 4 <= (SELECT count(*) FROM texts)),
ranked AS (SELECT r, i, w, row_number() OVER (PARTITION BY r, i ORDER BY n, w) AS k FROM (SELECT DISTINCT r, w FROM words WHERE w IN (SELECT w FROM rare)) JOIN (SELECT DISTINCT i, w FROM own) USING (w) JOIN rare USING (w)),
chosen AS (SELECT r, i, w, count(*) OVER (PARTITION BY r, i) AS c FROM ranked WHERE k <= 16),
hits AS (SELECT chosen.r, own.i, own.w, c, p - q AS d FROM chosen JOIN own USING (i, w) JOIN words ON words.r = chosen.r AND words.w = own.w WHERE c >= 6),
votes AS (SELECT DISTINCT r, i, w, c, unnest([floor(d / 8.0) * 8, floor((d + 4) / 8.0) * 8 - 4]) AS b FROM hits),
cover AS (SELECT r, i, max(share) AS share FROM (SELECT r, i, b, count(*) AS in_place, count(*) / max(c) AS share FROM votes GROUP BY r, i, b) JOIN notices USING (i) JOIN texts USING (r)
  WHERE in_place >= 6 AND share >= 0.5 AND contains(' ' || array_to_string(ws, ' ') || ' ', ' ' || key || ' ') GROUP BY r, i),
every AS (SELECT r, label FROM places WHERE label IS NOT NULL UNION SELECT r, label FROM cover JOIN notices USING (i)),
labelled AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM every GROUP BY r),
best AS (SELECT r, max(share) AS share FROM cover GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(greatest(CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END, coalesce(share, 0)) AS DOUBLE) AS score
FROM texts LEFT JOIN base USING (r) LEFT JOIN labelled USING (r) LEFT JOIN best USING (r)"""


def op6_pack_sequences(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    """All documents in sequences of at most 2048 ids of a public byte-level vocabulary."""
    import public_tokenizers

    pieces = packing.pack(_table(spark, folder, "documents"), tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    return packing.digest(pieces)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity, learned from the labels of ids whose crc32 is not a multiple of 5."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    lexicon = toxicity.train(docs, labels, toxicity.id_remainder("doc_id", 5) != 0)
    scored = docs.select("doc_id", (toxicity.id_remainder("doc_id", 5) == 0).alias("held_out"), toxicity.score("text", lexicon).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_line_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without lines that repeat, exactly or nearly, an earlier one."""
    docs = _table(spark, folder, "documents")
    kept = lines.without_repeated_lines(docs.select("doc_id", "text"))
    return kept.withColumn("n_lines", F.size(F.split("text", "\n")))


def op9_suffix_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    """All documents under a suffix tree and a unigram base, learned from ids whose crc32 leaves no 2 modulo 7."""
    return suffix_tree.score_documents(_table(spark, folder, "documents"), toxicity.id_remainder("doc_id", 7) == 2)


def op10_syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return syncmers.fingerprints(_table(spark, folder, "documents"))


def op11_whitened_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """The 16 main directions of all embeddings, each vector's place along them in units of their deviation."""
    return whitening.whiten(_table(spark, folder, "embeddings"), 16)


def op12_pack_few_sequences(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    """All documents in few sequences of at most 1024 ids of a public byte-level vocabulary."""
    import public_tokenizers

    return bins.pack_digest(_table(spark, folder, "documents"), tokenizer or public_tokenizers.path("byte_bpe_50k.json"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every conversation after the damage of the contract, and the cheapest repair."""
    return conversations.repair_digest(conversations.damaged(_table(spark, folder, "conversations")))


OP13_SQL = """
WITH RECURSIVE crc AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS v FROM range(256) AS r(i))),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ord(c) AS BIGINT)) AS bytes FROM conversations),
kinds AS (SELECT *, xor(list_reduce(bytes, lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1]), 4294967295), 4294967295) % 20 AS kind FROM keyed, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (SELECT *, left(role, 1) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS p FROM damaged),
judged AS (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
  lag(i) OVER (PARTITION BY conv_id ORDER BY p) || i AS pair FROM placed),
stats AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
  count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
steps AS (
  SELECT conv_id, n + 1 AS p, {'c': CAST(0 AS BIGINT), 'a': ''} AS s0, {'c': CAST(10 AS BIGINT), 'a': 'II'} AS s1, {'c': CAST(5 AS BIGINT), 'a': 'I'} AS s2, {'c': CAST(0 AS BIGINT), 'a': ''} AS s3 FROM stats
  UNION ALL
  SELECT conv_id, p, least(b0, {'c': 5 + n2.c, 'a': 'I' || n2.a}), least(b1, {'c': 5 + n2.c, 'a': 'I' || n2.a}), n2, least(b3, {'c': 5 + b2.c, 'a': 'I' || b2.a}) FROM (
    SELECT *, least(b2, {'c': 5 + b3.c, 'a': 'I' || b3.a}) AS n2 FROM (
      SELECT s.conv_id, r.p,
        CASE WHEN must THEN d0 WHEN i = 's' THEN least(d0, toU, {'c': t + s1.c, 'a': 'K' || s1.a}) WHEN i = 'u' THEN least(d0, toU, keepU) ELSE least(d0, toU) END AS b0,
        CASE WHEN must THEN d1 WHEN i = 'u' THEN least(d1, toU, keepU) ELSE least(d1, toU) END AS b1,
        CASE WHEN must THEN d2 WHEN i = 'a' THEN least(d2, toA, {'c': t + s3.c, 'a': 'K' || s3.a}) ELSE least(d2, toA) END AS b2,
        CASE WHEN must THEN d3 WHEN i = 'u' THEN least(d3, toU, keepU) ELSE least(d3, toU) END AS b3
      FROM (SELECT *, {'c': 2 + s0.c, 'a': 'D' || s0.a} AS d0, {'c': 2 + s1.c, 'a': 'D' || s1.a} AS d1, {'c': 2 + s2.c, 'a': 'D' || s2.a} AS d2, {'c': 2 + s3.c, 'a': 'D' || s3.a} AS d3 FROM steps) AS s
      JOIN (SELECT conv_id AS k, p, i, fault IN ('b', 'd') AS must, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS t FROM judged) AS r ON s.conv_id IS NOT DISTINCT FROM r.k AND r.p = s.p - 1,
      LATERAL (SELECT {'c': 1 + t + s2.c, 'a': 'R' || s2.a} AS toU, {'c': t + s2.c, 'a': 'K' || s2.a} AS keepU, {'c': 1 + t + s3.c, 'a': 'R' || s3.a} AS toA) AS o))),
best AS (SELECT conv_id, s0.c AS cost, s0.a AS audit, string_split(s0.a, '') AS letters FROM steps WHERE p = 1),
edits AS (SELECT conv_id, len(list_filter(letters, lambda x: x <> 'D')) AS kept, unnest(letters) AS e, generate_subscripts(letters, 1) AS step FROM best WHERE audit <> ''),
counted AS (SELECT *, count(*) FILTER (e <> 'I') OVER w AS p, count(*) FILTER (e <> 'D') OVER w AS place FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY step)),
repaired AS (SELECT c.conv_id, string_agg(CASE WHEN e = 'K' THEN j.role WHEN (place - kept % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE j.text END, chr(10) ORDER BY place) AS whole
  FROM counted AS c LEFT JOIN judged AS j ON c.conv_id IS NOT DISTINCT FROM j.conv_id AND c.p = j.p WHERE e <> 'D' GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN stats ON o.conv_id IS NOT DISTINCT FROM stats.conv_id
LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN repaired ON o.conv_id IS NOT DISTINCT FROM repaired.conv_id"""


QUERIES = {
    "op1_mix_sources": (op1_mix_sources, None),
    "op2_embedding_duplicates": (op2_embedding_duplicates, OP2_SQL),
    "op3_simhash_duplicates": (op3_simhash_duplicates, None),
    "op4_secret_scan": (op4_secret_scan, OP4_SQL),
    "op5_license_scan": (op5_license_scan, OP5_SQL),
    "op6_pack_sequences": (op6_pack_sequences, None),
    "op7_toxicity": (op7_toxicity, None),
    "op8_line_duplicates": (op8_line_duplicates, None),
    "op9_suffix_tree_scores": (op9_suffix_tree_scores, None),
    "op10_syncmer_fingerprints": (op10_syncmer_fingerprints, None),
    "op11_whitened_embeddings": (op11_whitened_embeddings, None),
    "op12_pack_few_sequences": (op12_pack_few_sequences, None),
    "op13_conversation_repair": (op13_conversation_repair, OP13_SQL),
}


def all_queries() -> dict:
    return {name: run for name, (run, _) in QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
