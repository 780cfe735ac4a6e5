"""The registered queries of the training-data operators and their SQL.

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitals.llm import (
    collocations, curriculum, decontaminate, hnsw, jaccard_join, licenses, minhash, piece_table, pii, quality, suffixes, tokens, toxicity,
)
from vitals.llm.common import stored, table


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc.doc_id", F.coalesce(toxicity.fold("doc.doc_id") == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.read_documents(spark, tokens.write(table(spark, sf, "documents")))


def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_resample(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality.resample(docs, quality.fit(docs, table(spark, sf, "labels")))


def op5_licenses(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.scan(table(spark, sf, "documents"))
    return found.select("doc_id", "license", F.round("dice", 9).alias("dice"), "units")


def op6_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    left = suffixes.deduplicated(table(spark, sf, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return left.select(
        "kept.doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("rest", 256).alias("kept_sha256"))


def op7_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return minhash.classes(docs).select("doc.doc_id", "class_id", (F.col("row") == F.col("class_row")).alias("kept"))


def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    weights, _ = pii.fit(docs)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return pii.find(docs, weights).select(
        "doc.doc_id", *[count(k) for k in pii.BASE_KINDS], F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"))


def op9_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = curriculum.positions(stored(curriculum.mix(table(spark, sf, "documents")), "mixed"))
    return mixed.select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", F.round("time", 9).alias("time"), "position")


def op10_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf, "embeddings"))


def op11_fim(spark: SparkSession, sf: str) -> DataFrame:
    rows = piece_table.transformed(table(spark, sf, "documents").select("doc_id", "text"))
    return rows.select("doc.doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op12_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.joined(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


def _bigrams(words: str) -> str:
    return f"list_distinct(list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP5_SQL = f"""WITH templates AS (
    SELECT license, {_bigrams("words")} AS template FROM (
        SELECT license, string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS words
        FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, ts in licenses.TEMPLATES.items() for t in ts)}) v(license, text))
), units AS (
    SELECT DISTINCT doc_id, text AS whole, unnest(list_concat(
        string_split(coalesce(text, ''), chr(10)), regexp_split_to_array(coalesce(text, ''), '\\n[ \\t\\r]*\\n'))) AS unit
    FROM documents
), sets AS (
    SELECT doc_id, {_bigrams("words")} AS bigrams FROM (
        SELECT doc_id, string_split(trim(regexp_replace(lower(unit), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS words FROM units)
    WHERE len(words) > 1
), scored AS (
    SELECT doc_id, license, list_sort(bigrams) AS bigrams,
        2.0::DOUBLE * len(list_intersect(bigrams, template)) / (len(bigrams) + len(template)) AS dice
    FROM sets, templates
)
SELECT doc_id, license, round(max(dice), 9) AS dice, count(DISTINCT bigrams) AS units
FROM scored WHERE dice >= {licenses.THRESHOLD}::DOUBLE GROUP BY doc_id, license"""


def _due_time(share: str, knots) -> str:
    """The inverse of the integrated schedule, piece by piece."""
    areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(knots, knots[1:])]
    total, done, arms = sum(areas), 0.0, []

    def number(value: float) -> str:
        return f"({float(value)!r}::DOUBLE)"

    for ((t0, r0), (t1, r1)), area in zip(zip(knots, knots[1:]), areas):
        rest = f"greatest({share} * {number(total)} - {number(done)}, 0::DOUBLE)"
        root = f"sqrt(greatest({number(r0 * r0)} + {number(2 * (r1 - r0) / (t1 - t0))} * {rest}, 0::DOUBLE))"
        x = f"CASE WHEN {rest} <= 0 THEN 0::DOUBLE ELSE 2::DOUBLE * {rest} / ({number(r0)} + {root}) END"
        arms.append(f"WHEN {share} * {number(total)} <= {number(done + area)} THEN least({number(t0)} + {x}, {number(t1)})")
        done += area
    return f"CASE {' '.join(arms)} ELSE {number(knots[-1][0])} END"


_TIMES = " ".join(f"WHEN {n} THEN {_due_time('share', knots)}" for n, knots in enumerate(curriculum.SCHEDULES))

OP9_SQL = f"""WITH docs AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS turn,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM docs GROUP BY source
), weighed AS (
    SELECT *, CASE place % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight,
        source_size * 2.0::DOUBLE AS room FROM sources
), levels AS (
    SELECT *, room / weight AS ratio,
        (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(room) OVER ahead, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER ahead, 0)) AS level
    FROM weighed WINDOW ahead AS (ORDER BY room / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, place, source_size, least(room, coalesce(weight * (
        SELECT level FROM levels WHERE ratio > level ORDER BY ratio, place LIMIT 1), room)) AS target FROM levels
), laid AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY turn, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM docs
), mixed AS (
    SELECT row_number() OVER () AS r, doc_id, size, source_size, target, start, place,
        greatest(0, least(size, floor(target) - start)) AS once, greatest(0, least(size, floor(target) - start - source_size)) AS again
    FROM laid JOIN targets ON laid.source IS NOT DISTINCT FROM targets.source
), takes AS (
    SELECT *, 0 AS repeat, once AS words, CAST(start AS DOUBLE) / target AS share FROM mixed WHERE once > 0
    UNION ALL SELECT *, 1, again, CAST(start + source_size AS DOUBLE) / target FROM mixed WHERE again > 0
), timed AS (
    SELECT *, CASE place % {len(curriculum.SCHEDULES)} {_TIMES} END AS time FROM takes
), placed AS (
    SELECT *, coalesce(sum(words) OVER (ORDER BY time, doc_id, size, repeat ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position
    FROM timed
)
SELECT mixed.doc_id, mixed.size, mixed.source_size, round(mixed.target, 6) AS target, CAST(mixed.once + mixed.again AS BIGINT) AS taken,
    round(time, 9) AS time, CAST(position AS BIGINT) AS position
FROM mixed LEFT JOIN placed ON mixed.r = placed.r AND repeat = 0"""


OP11_SQL = r"""WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM documents
), numbers AS (
    SELECT doc_id, text, units, len(units) AS n, CAST('0x' || key[1:8] AS BIGINT) AS h1, CAST('0x' || key[9:16] AS BIGINT) AS h2,
        CAST('0x' || key[17:24] AS BIGINT) AS h3, CAST('0x' || key[25:32] AS BIGINT) AS h4 FROM hashed
), cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
            WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM numbers
), parts AS (
    SELECT *, array_to_string(units[:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
        array_to_string(units[high + 1:], '') AS suffix FROM cut
), made AS (
    SELECT *, CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END AS output FROM parts
), places AS (
    SELECT *, strpos(output, '<P>') AS p, strpos(output, '<S>') AS s, strpos(output, '<M>') AS m FROM made
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(output) AS output_sha256,
    sha256(CASE form WHEN 'psm' THEN output[4:s - 1] || output[m + 3:] || output[s + 3:m - 1]
        WHEN 'spm' THEN output[p + 3:m - 1] || output[m + 3:] || output[4:p - 1] ELSE output END) AS restored_sha256
FROM places"""


_CAPITALS = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = rf"""WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_CAPITALS}, '[^\x20\x09-\x0D]+') AS words FROM documents
), sets AS (
    SELECT r, doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles FROM texts
), sized AS (
    SELECT r, doc_id, len(shingles) AS size, shingles FROM sets
), exploded AS (
    SELECT r, size, unnest(shingles) AS shingle FROM sized
), shared AS (
    SELECT a.r AS a, b.r AS b, count(*) AS shared, any_value(a.size) AS size_a, any_value(b.size) AS size_b
    FROM exploded a JOIN exploded b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY a.r, b.r
), links AS (
    SELECT a, b FROM shared WHERE 100 * shared >= {jaccard_join.PERCENT} * (size_a + size_b - shared)
), reach AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
    SELECT a, min(doc_id) AS doc_id FROM reach JOIN sized ON reach.b = sized.r GROUP BY a
)
SELECT sized.doc_id, CAST(size AS BIGINT) AS n_shingles, least(sized.doc_id, least.doc_id) AS component_id
FROM sized LEFT JOIN least ON sized.r = least.a"""


OP13_SQL = rf"""WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_CAPITALS}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (SELECT unnest([1, 2, 3, 4]) AS k), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words, sizes WHERE len(w) >= k
), f AS (
    SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, k, phrase
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a, w FROM f WHERE k > 1 AND f >= {collocations.LEAST}
), cuts AS (
    SELECT *, unnest(range(1, k)) AS c FROM candidates
), scored AS (
    SELECT cuts.lang, cuts.k, cuts.phrase, a, c, l.f AS l, r.f AS r,
        CAST(CAST({collocations.SCALE} AS HUGEINT) * a // (l.f + r.f) AS BIGINT) AS score
    FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(cuts.w[:c], ' ')
        JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(cuts.w[c + 1:], ' ')
    QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, c) = 1
), kept AS (
    SELECT * FROM scored s WHERE NOT EXISTS (
        SELECT 1 FROM candidates o WHERE o.lang = s.lang AND o.k > s.k AND 100 * o.a >= {collocations.INSIDE_PERCENT} * s.a
            AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' '))
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {collocations.TOP}"""


QUERIES = {
    "op1_toxicity": op1_toxicity, "op2_tokens": op2_tokens, "op3_decontaminate": op3_decontaminate, "op4_resample": op4_resample,
    "op5_licenses": op5_licenses, "op6_suffixes": op6_suffixes, "op7_near_duplicates": op7_near_duplicates, "op8_pii": op8_pii,
    "op9_mix": op9_mix, "op10_nearest": op10_nearest, "op11_fim": op11_fim, "op12_jaccard": op12_jaccard,
    "op13_collocations": op13_collocations,
}
SQL = {"op5_licenses": OP5_SQL, "op9_mix": OP9_SQL, "op11_fim": OP11_SQL, "op12_jaccard": OP12_SQL, "op13_collocations": OP13_SQL}
