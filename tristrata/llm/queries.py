"""The registered queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_cnn, chat, fm_toxicity, importance, jaccard_join, langid, license_scan, mixing, packing, pq_neardup, rp_forest, runs, separators
from .tables import held_out, table

TOXIC_FROM = 0.7
GOOD_FROM = 0.5


def op1_pq_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_neardup.near_copies(table(spark, sf_dir, "embeddings"), 0.93)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], rows.schema)
    rows = rows.unionByName(added)
    records = rows.select("conv_id", F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    return chat.read_back(chat.format_chat(chat.canonical_turns(records)))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).rows


def op4_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separators.document_counts(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, ~held_out(F.col("doc_id")))
    return langid.identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_drr_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digest(packing.pack(table(spark, sf_dir, "documents")))


def op7_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"), groups_only=True).members.select("doc_id", "n_shingles", "component_id")


def op9_fm_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fm_toxicity.fit(docs, labels.where(~held_out(F.col("doc_id"))), "toxic")
    return fm_toxicity.score(docs, model, TOXIC_FROM).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = byte_cnn.fit(docs, labels.where(~held_out(F.col("doc_id"))), "quality")
    return fm_toxicity.score(docs, model, GOOD_FROM).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_labels(table(spark, sf_dir, "documents"))


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), tails=True).drop("n_words")


QUERIES = {
    f.__name__: f
    for f in (
        op1_pq_neardup,
        op2_chat_format,
        op3_mix_sources,
        op4_separator_scan,
        op5_language_id,
        op6_drr_packing,
        op7_rp_forest,
        op8_ngram_jaccard,
        op9_fm_toxicity,
        op10_byte_cnn,
        op11_license_diagonals,
        op12_importance_resample,
        op13_periodic_runs,
    )
}

_REACH = """
reach AS (SELECT a AS node, a AS far FROM nodes UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.far)
"""

_OP1 = f"""
WITH RECURSIVE v AS (SELECT vec_id AS a, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL),
both_ways AS (
    SELECT l.a, r.a AS b FROM v l JOIN v r ON l.label = r.label AND l.a <> r.a
    WHERE list_cosine_similarity(l.x, r.x) >= 0.93),
nodes AS (SELECT vec_id AS a FROM embeddings),
{_REACH},
roots AS (SELECT node, min(far) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT node AS vec_id, coalesce(n, 0) AS n_links, component_id, node = component_id AS kept
FROM roots LEFT JOIN counts ON counts.a = node
"""

_ESCAPED = r"replace(replace(replace({0}, '\', '\\'), '#', '\#'), '</', '<\/')"
_OP2 = rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(4 + length({_ESCAPED.format("role")}) + 1 + length({_ESCAPED.format("text")}) + 9) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


def _draw(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('/', {', '.join(parts)})), 1, 8) AS BIGINT)"


def _place(epoch: str, block: str) -> str:
    step = _draw("'0'", "name", f"CAST({epoch} AS VARCHAR)", "'step'")
    shift = _draw("'0'", "name", f"CAST({epoch} AS VARCHAR)", "'shift'")
    return f"CAST(({block} * (({step} * 2 + 1) % 1024) + {shift}) % 1024 AS INTEGER)"


_OP3 = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, coalesce(source, 'null') AS name,
        CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS tokens,
        CAST({_draw("'0'", "coalesce(CAST(doc_id AS VARCHAR), 'null')")} % 1024 AS INTEGER) AS block
    FROM documents),
sizes AS (SELECT source, name, sum(tokens)::BIGINT AS tokens FROM d GROUP BY ALL),
facts AS (SELECT sum(tokens)::DOUBLE AS total, max(tokens)::DOUBLE AS most, min(tokens)::DOUBLE AS least, count(*) AS n FROM sizes WHERE tokens > 0),
halves AS (
    SELECT 0 AS k, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high
    UNION ALL
    SELECT k + 1, CASE WHEN flat THEN (low + high) / 2 ELSE low END, CASE WHEN flat THEN high ELSE (low + high) / 2 END
    FROM (
        SELECT k, low, high, (SELECT ln(sum(pow(tokens / total, e))) - sum(pow(tokens / total, e) * ln(pow(tokens / total, e))) / sum(pow(tokens / total, e))
                              >= 0.98 * ln(max(n)) FROM sizes, facts, (SELECT (h.low + h.high) / 2 AS e) WHERE tokens > 0) AS flat
        FROM halves h WHERE k < 50)),
by_entropy AS (SELECT CASE
        WHEN (SELECT ln(sum(tokens / total)) - sum(tokens / total * ln(tokens / total)) / sum(tokens / total) >= 0.98 * ln(max(n)) FROM sizes, facts WHERE tokens > 0) THEN 1
        ELSE (SELECT low FROM halves WHERE k = 50) END AS e),
exponent AS (SELECT CASE WHEN n <= 1 THEN 1 ELSE greatest(by_entropy.e, CASE WHEN most / least <= 2 THEN 0 ELSE 1 - ln(2) / ln(most / least) END) END AS e FROM facts, by_entropy),
uses AS (
    SELECT source, name, tokens, CASE WHEN tokens > 0 THEN round(pow(most / tokens, 1 - e), 9) ELSE 1 END AS u
    FROM sizes, facts, exponent),
plan AS (SELECT source, name, floor(u)::INTEGER AS whole, round(tokens * u)::BIGINT - floor(u)::BIGINT * tokens AS rest FROM uses),
blocks AS (
    SELECT name, whole, rest, {_place("whole", "block")} AS place, sum(tokens)::BIGINT AS tokens
    FROM d JOIN plan USING (name) GROUP BY name, whole, rest, block),
stops AS (
    SELECT name, max(place) + 1 AS stop
    FROM (SELECT name, place, rest, coalesce(sum(tokens) OVER (PARTITION BY name ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM blocks)
    WHERE before < rest GROUP BY name),
used AS (
    SELECT d.doc_id, d.source, name, d.tokens, block,
        unnest(range(0, whole + CASE WHEN {_place("whole", "block")} < coalesce(stop, 0) THEN 1 ELSE 0 END)) AS epoch
    FROM d JOIN plan USING (name) LEFT JOIN stops USING (name))
SELECT doc_id, source, tokens, CAST(epoch AS INTEGER) AS epoch, block, {_place("epoch", "block")} AS place FROM used
"""

_OP8 = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS gram
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS c FROM s l JOIN s r ON l.gram = r.gram AND l.doc_id < r.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT doc_id AS a FROM documents),
{_REACH}
SELECT node AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(far) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = node GROUP BY node
"""

_WORDS = rf"""regexp_extract_all(translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'), '{license_scan.WORD}')"""


def _notices() -> str:
    rows = []
    for i, n in enumerate(license_scan.PHRASES + license_scan.NOTICES):
        k = min(license_scan.GRAM, len(n.words))
        gap = 0 if n.base else license_scan.gap_of(len(n.words), license_scan.GAP)
        rows += [
            f"({i}, '{n.label}', {n.base}, {len(n.words)}, {len(n.words) - k + 1}, {gap}, {k}, {at}, '{' '.join(n.words[at : at + k])}')"
            for at in range(len(n.words) - k + 1)
        ]
    return ", ".join(rows)


_OP11 = rf"""
WITH notices(notice, label, base, words, grams, gap, k, j, gram) AS (VALUES {_notices()}),
w AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w FROM documents),
here AS (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM notices)),
hits AS (SELECT id, i - 1 AS place, n.* FROM here JOIN notices n ON n.k = here.k AND n.gram = array_to_string(w[i : i + here.k - 1], ' ')),
diagonals AS (SELECT DISTINCT id, notice, gap, place - j AS diagonal FROM hits),
apart AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY id, notice ORDER BY diagonal) > gap, false) AS apart FROM diagonals),
spans AS (SELECT id, notice, diagonal, count(*) FILTER (WHERE apart) OVER (PARTITION BY id, notice ORDER BY diagonal) AS span FROM apart),
found AS (
    SELECT h.id, h.notice, label, base, words, count(DISTINCT j) / CAST(any_value(grams) AS DOUBLE) AS found,
        min(place) AS first_word, max(place + k - 1) AS last_word
    FROM hits h JOIN spans s ON s.id = h.id AND s.notice = h.notice AND s.diagonal = h.place - h.j GROUP BY h.id, h.notice, label, base, words, span),
judged AS (SELECT *, CASE WHEN base THEN found = 1 ELSE found >= {license_scan.SHARE} AND last_word - first_word + 1 <= words * {license_scan.STRETCH} END AS counts FROM found),
labels AS (
    SELECT id, count(*) FILTER (WHERE counts AND base) AS n_base, min(first_word) FILTER (WHERE counts AND base) AS first_word,
        max(first_word) FILTER (WHERE counts AND base) AS last_word,
        array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE counts AND base)), ',') AS base_labels,
        array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE counts)), ',') AS labels, max(found) AS score
    FROM judged GROUP BY id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
    coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN labels USING (id)
"""

_OP12 = rf"""
WITH crcs AS (SELECT list(c ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k : CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))),
w AS (
    SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w, false AS target FROM documents
    UNION ALL SELECT -row_number() OVER (), NULL, {_WORDS}, true FROM benchmark),
runs AS (
    SELECT id, target, array_to_string(w[i : i + k - 1], ' ') AS f
    FROM (SELECT id, target, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k))),
counted AS (SELECT id, target, f, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
    SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(f) + 1), lambda i : CAST('0x' || substr(hex(encode(f)), 2 * i - 1, 2) AS BIGINT))),
        lambda c, b : xor(c >> 8, crc[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % {importance.BUCKETS} AS bucket
    FROM (SELECT DISTINCT f FROM counted), crcs),
placed AS (SELECT id, target, bucket, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
shares AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE NOT target), 0) AS s, coalesce(sum(n) FILTER (WHERE target), 0) AS t FROM placed GROUP BY bucket),
whole AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM shares),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + {importance.BUCKETS}) AS DOUBLE) / CAST((s + 1) * (t_all + {importance.BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain
    FROM shares, whole),
weights AS (SELECT id, sum(n) AS n_features, sum(n * gain) AS weight FROM placed JOIN gains USING (bucket) WHERE NOT target GROUP BY id),
scored AS (
    SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST(coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS BIGINT) AS score
    FROM w LEFT JOIN weights USING (id) WHERE NOT target),
placings AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC NULLS LAST, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
    CASE WHEN n_words >= 20 AND place <= 5 * (SELECT count(*) FROM scored WHERE n_words >= 20) // 100 THEN place END AS rank
FROM placings
"""

ORACLES = {"op11_license_diagonals": _OP11, "op12_importance_resample": _OP12, "op1_pq_neardup": _OP1, "op2_chat_format": _OP2, "op3_mix_sources": _OP3, "op8_ngram_jaccard": _OP8}
