"""DuckDB SQL that states the operators' results independently of the Spark code."""

from __future__ import annotations

from murmur.llm import embeddings, licenses, lines, mixing, quality, ranked, substrings

WORD = r"[^\x20\x09-\x0D]+"


def _ngram_cover(n: int, name: str) -> str:
    return f"""{name} AS (
  SELECT doc_id, cast(sum(len) AS bigint) AS chars FROM words WHERE (doc_id, pos) IN (
    SELECT doc_id, unnest(range(pos, pos + {n})) FROM (
      SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, gram ORDER BY pos) AS nth FROM (
        SELECT doc_id, pos, [{', '.join(f'lead(word, {k}) OVER w' for k in range(n))}] AS gram,
          lead(pos, {n - 1}) OVER w AS last FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
      WHERE last IS NOT NULL) WHERE nth > 1)
  GROUP BY doc_id)"""


def _quality() -> str:
    grams = quality.MAX_NGRAM_COVER
    covers = ",\n".join(_ngram_cover(n, f"g{n}") for n in grams)
    columns = ", ".join(f"coalesce(g{n}.chars, 0) AS dup_{n}gram_chars" for n in grams)
    joins = " ".join(f"LEFT JOIN g{n} USING (doc_id)" for n in grams)
    good = " AND ".join([f"dup_line_chars <= cast({quality.MAX_LINE_COVER} AS double) * word_chars",
                         *(f"dup_{n}gram_chars <= cast({c} AS double) * word_chars" for n, c in grams.items())])
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, pos, word, length(word) AS len FROM (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM (
      SELECT doc_id, regexp_extract_all(text, '{WORD}') AS w FROM texts))),
sizes AS (SELECT doc_id, count(*) AS n_words, cast(sum(len) AS bigint) AS word_chars FROM words GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, cast(sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS bigint) AS chars FROM (
    SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth FROM (
      SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM texts))
    WHERE regexp_matches(line, '{WORD}')) WHERE nth > 1 GROUP BY doc_id),
g3 AS (
  SELECT doc_id, count(DISTINCT spot) AS n FROM (
    SELECT doc_id, unnest(range(pos, pos + 3)) AS spot FROM (
      SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM (
        SELECT doc_id, pos, word AS a, lead(word) OVER w AS b, lead(word, 2) OVER w AS c FROM words
        WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) WHERE c IS NOT NULL) WHERE n > 1) GROUP BY doc_id),
{covers},
measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(g3.n, 0) AS n_repeat_words,
    coalesce(lines.chars, 0) AS dup_line_chars, {columns}
  FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN g3 USING (doc_id) {joins})
SELECT *, NOT base_failed AND {good} AS kept FROM (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured)"""


QUALITY = _quality()

MIXING = f"""WITH sized AS (
  SELECT doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS bigint) AS size,
    cast('0x' || substr(md5(coalesce(cast(doc_id AS varchar), '')), 1, 12) AS bigint) AS h FROM documents),
src AS (
  SELECT source, source_size, [{', '.join(map(str, mixing.WEIGHTS))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS weight
  FROM (SELECT source, cast(sum(size) AS bigint) AS source_size FROM sized GROUP BY source)),
filled AS (
  SELECT *, (1.5::double * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER earlier, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM src WINDOW earlier AS (ORDER BY 2.0::double * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (
  SELECT *, target - whole * source_size AS rest FROM (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM (
      SELECT source, source_size, least(2.0::double * source_size, weight *
        (SELECT coalesce(arg_min(level, 2.0::double * source_size / weight) FILTER (WHERE 2.0::double * source_size > level * weight), 0) FROM filled)) AS target FROM src))),
summed AS (
  SELECT s.*, g.* EXCLUDE (source), sum(size) OVER (PARTITION BY s.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY s.source, h) AS own
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, cast(size * (whole + CASE WHEN upto <= rest
  OR upto - own <= rest AND upto - rest < rest - (upto - own) THEN 1 ELSE 0 END) AS bigint) AS taken FROM summed"""


def _substrings(window: int) -> str:
    gram = ", ".join(["word", *(f"lead(word, {k}) OVER w" for k in range(1, window))])
    return f"""WITH words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents)),
late AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY gram ORDER BY doc_id, pos) AS nth FROM (
    SELECT doc_id, pos, md5(concat_ws(' ', {gram})) AS gram, lead(pos, {window - 1}) OVER w AS last FROM words
    WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) WHERE last IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + {window})) AS pos FROM late WHERE nth > 1),
kept AS (
  SELECT w.doc_id, count(*) AS n_words, count(g.pos) AS n_removed,
    coalesce(string_agg(w.word, ' ' ORDER BY w.pos) FILTER (WHERE g.pos IS NULL), '') AS kept
  FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.pos = w.pos GROUP BY w.doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)"""


SUBSTRINGS = _substrings(substrings.WINDOW)

EMBEDDINGS = f"""WITH RECURSIVE sound AS (
  SELECT vec_id, cast(embedding AS double[]) AS v, len(embedding) AS dim FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND a.dim = b.dim
  WHERE CASE WHEN a.dim = b.dim THEN list_cosine_similarity(a.v, b.v) END >= cast({embeddings.COSINE} AS double)),
reached AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, r.least AS component_id, e.vec_id = r.least AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS least FROM reached GROUP BY a) r ON r.a = e.vec_id"""


def _licenses() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rules = ", ".join(f"({k}, {quoted(r.label)}, {quoted(r.keyword)}, {quoted(r.regex)}, {r.confidence})" for k, r in enumerate(licenses.RULES))
    gate = " OR ".join(f"contains(low, {quoted(g)})" for g in licenses.GATE)
    place = lambda p: " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(p.split(), 1))
    label = " ".join(f"WHEN {place(p)} THEN '{name}'" for p, name in licenses.BASE.items())
    return f"""WITH rules(prio, label, keyword, rx, confidence) AS (VALUES {rules}),
lowered AS (SELECT doc_id, translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}') AS low FROM documents),
split AS (SELECT doc_id, low, regexp_extract_all(low, '{licenses.WORD}') AS words FROM lowered),
base AS (
  SELECT doc_id, count(*) AS n, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels FROM (
    SELECT doc_id, i, CASE {label} END AS label FROM (SELECT doc_id, words, unnest(range(0, len(words))) AS i FROM split WHERE contains(low, 'license')))
  WHERE label IS NOT NULL GROUP BY doc_id),
gated AS (SELECT doc_id, ' ' || array_to_string(words, '  ') || ' ' AS norm FROM split WHERE len(words) > 0 AND ({gate})),
matched AS (
  SELECT doc_id, prio, label, confidence, regexp_extract_all(norm, rx) AS m, string_split_regex(norm, rx) AS p
  FROM gated JOIN rules ON contains(norm, keyword) WHERE regexp_matches(norm, rx)),
placed AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM matched),
spans AS (
  SELECT doc_id, prio, label, confidence, b, b + len(m[i]) AS e FROM (
    SELECT *, list_sum(list_transform(p[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS b FROM placed)),
kept AS (
  SELECT * FROM (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY b, e DESC, prio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM spans)
  WHERE upto IS NULL OR e > upto),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, product(1 - cast(confidence AS double) / 2) AS doubt FROM kept GROUP BY doc_id)
SELECT s.doc_id, cast(len(words) AS bigint) AS n_words, coalesce(b.n, 0) AS n_base, b.first_word, b.last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, f.labels))), ','), '') AS labels,
  round(1 - coalesce(f.doubt, 1.0::double) * CASE WHEN b.n > 0 THEN 0.1::double ELSE 1.0::double END, 9) AS score
FROM split s LEFT JOIN base b USING (doc_id) LEFT JOIN found f USING (doc_id)"""


LICENSES = _licenses()


def _lines(min_chars: int, min_docs: int) -> str:
    blanks = " || ".join(f"chr({ord(c)})" for c in lines.BLANKS)
    return f"""WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
rows AS (
  SELECT doc_id, pos, line, translate(trim(line, {blanks}), '{lines.UPPER}', '{lines.LOWER}') AS key FROM (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM split)),
common AS (
  SELECT key, max(doc_id) AS last FROM rows WHERE length(key) >= {min_chars} GROUP BY key HAVING count(DISTINCT doc_id) >= {min_docs}),
marked AS (SELECT r.*, c.key IS NOT NULL AND doc_id <> c.last AS gone FROM rows r LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


LINES = _lines(lines.MIN_CHARS, lines.MIN_DOCS)


def _ranked(top: int) -> str:
    words = f"""regexp_extract_all(translate(coalesce(text, ''), '{lines.UPPER}', '{lines.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
    return f"""WITH item_terms AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({words}) AS term FROM benchmark) GROUP BY item_id, term),
docs AS (SELECT row_number() OVER () AS row, doc_id, {words} AS terms FROM documents),
whole AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, cast(sum(len(terms)) AS bigint) AS n_terms FROM docs),
held AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, cast(len(terms) AS bigint) AS n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY row, doc_id, n, term),
weights AS (
  SELECT term, cast(floor(1000 * ln(cast(2 * n_docs + 2 AS double) / cast(2 * df + 1 AS double))) AS bigint) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), whole),
scored AS (
  SELECT item_id, row, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS bigint) AS score
  FROM held JOIN weights USING (term) JOIN item_terms USING (term), whole GROUP BY item_id, row, doc_id)
SELECT item_id, cast(rank AS integer) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= {top}"""


RANKED = _ranked(ranked.TOP)
