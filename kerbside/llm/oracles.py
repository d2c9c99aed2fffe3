"""DuckDB statements for the queries of this folder that SQL can express."""

from __future__ import annotations

from kerbside.llm import quality, secrets

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _quality() -> str:
    def bins(lang: str) -> str:
        return "[" + ", ".join(f"len(list_filter(words, lambda x: x = '{w}'))" for w in quality.COMMON_WORDS[lang]) + "]"

    case = " ".join(f"WHEN '{k}' THEN {bins(k)}" for k in quality.COMMON_WORDS if k != quality.OTHER_LANGUAGE)
    n_chars, n_bins = len(quality.CHAR_CLASSES), quality.BINS + 1

    def left(cls: str) -> str:
        return f"(length(rest) - length(regexp_replace(rest, '[{cls}]+', '', 'g')))"

    def mean(name: str, n: int) -> str:
        return "[" + ", ".join(f"avg({name}[{i + 1}])" for i in range(n)) + f"] AS ref_{name}"

    def distance(p: str, q: str) -> str:
        def part(x: str) -> str:
            return f"CASE WHEN {x} > 0 THEN {x} * log2({x} / ((z[1] + z[2]) / 2)) ELSE 0.0 END"

        pairs = f"list_zip({p}, {q})"
        terms = f"list_transform({pairs}, lambda z: ({part('z[1]')} + {part('z[2]')}) / 2)"
        return f"sqrt(greatest(list_sum({terms}), 0.0))"

    return rf"""
WITH a AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text, {WORDS} AS words,
         regexp_replace(coalesce(text, ''), '[a-z\x20\x09-\x0D]+', '', 'g') AS rest FROM documents
), b AS (
  SELECT *, list_transform(range(1, greatest(len(words) - 1, 1)), lambda i: words[i] || ' ' || words[i+1] || ' ' || words[i+2]) AS tri,
         length(list_aggregate(words, 'string_agg', '')) AS wc FROM a
), c AS (
  SELECT *, len(list_distinct(flatten(list_transform(
              list_filter(range(1, len(tri) + 1), lambda i: list_contains(twice, tri[i])), lambda i: [i, i + 1, i + 2])))) AS rep
  FROM (SELECT b.*, coalesce(list_filter(map_keys(h), lambda k: h[k] > 1), []) AS twice
        FROM (SELECT *, list_histogram(tri) AS h FROM b) AS b)
), d AS (
  SELECT doc_id, lang, len(words)::BIGINT AS n_words, coalesce(wc, 0)::BIGINT AS word_chars, length(text) AS n_chars,
         {left("#*$%&|<>")}::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, rep::BIGINT AS n_repeat_words,
         length(text) - length(rest) - (length(text) - coalesce(wc, 0)) AS lo, {left("A-Z")} AS up, {left("0-9")} AS di,
         length(text) - coalesce(wc, 0) AS sp, {left(".,;:''()" + chr(34) + "?-")} AS st, {left(r"\x00-\x7F")} AS asc_, length(rest) AS lr,
         CASE lang {case} ELSE {bins(quality.OTHER_LANGUAGE)} END AS cw
  FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM c)
), e AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         list_transform([lo, up, di, sp, st, asc_ - up - di - st, lr - asc_], lambda x: x / greatest(n_chars, 1)::DOUBLE) AS chars,
         list_transform(list_append(cw, n_words - list_sum(cw)), lambda x: x / greatest(n_words, 1)::DOUBLE) AS common
  FROM d
), r AS (
  SELECT lang, {mean("chars", n_chars)}, {mean("common", n_bins)} FROM e WHERE NOT base_failed GROUP BY lang
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND NOT coalesce(n_chars >= {quality.MIN_CHARS} AND {distance("chars", "ref_chars")} > {quality.MAX_CHAR_DISTANCE}, false)
       AND NOT coalesce(n_words >= {quality.MIN_WORDS} AND {distance("common", "ref_common")} > {quality.MAX_WORD_DISTANCE}, false) AS kept
FROM e LEFT JOIN r USING (lang)"""


def _secrets() -> str:
    parts = []
    for order, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        value = f"regexp_extract(hits[i], '{pattern}', {rule.group})" if rule.group else "hits[i]"
        parts.append(rf"""
SELECT doc_id, {order} AS o, '{rule.kind}' AS kind, s, s + length(hits[i]) AS e FROM (
  SELECT doc_id, i, hits, (coalesce(list_sum(list_transform(pieces[1:i], lambda x: length(x))), 0)
         + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0))::BIGINT AS s
  FROM (SELECT doc_id, hits, pieces, unnest(range(1, len(hits) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(text, '{pattern}') AS hits, regexp_split_to_array(text, '{pattern}') AS pieces
    FROM documents WHERE regexp_matches(text, '{pattern}')))
) WHERE length({value}) >= {rule.least}""")
    base = ", ".join(f"'{r.kind}'" for r in secrets.BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE_RULES)
    item = "kind || ':' || s || ':' || e"
    return f"""
WITH f AS ({" UNION ALL ".join(parts)})
SELECT doc_id, {counts}, sha256(coalesce(string_agg({item}, ',' ORDER BY s, o) FILTER (kind IN ({base})), '')) AS base_sha256,
       coalesce(string_agg({item}, ',' ORDER BY s, o) FILTER (kind IS NOT NULL), '') AS spans
FROM documents LEFT JOIN f USING (doc_id) GROUP BY doc_id"""


def _collocations() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def grams(n: int) -> str:
        phrase = " || ' ' || ".join(f"w[i+{j}]" if j else "w[i]" for j in range(n))
        cells = f"list_transform(range(1, greatest(len(w) - {n - 2}, 1)), lambda i: {phrase})"
        return f"SELECT lang, {n} AS size, unnest({cells}) AS phrase FROM w"

    return rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p
), f AS (
  SELECT lang, size, phrase, count(*) AS f, string_split(phrase, ' ') AS w
  FROM ({grams(1)} UNION ALL {grams(2)} UNION ALL {grams(3)}) GROUP BY ALL
), n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (
  SELECT f.lang, f.size, f.phrase, f.f AS a, k, x.f AS l, y.f AS r,
         (1000000::HUGEINT * f.f * f.f // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM f, (VALUES (1), (2)) AS cuts(k), f AS x, f AS y
  WHERE f.f >= 10 AND f.size > k AND x.lang = f.lang AND y.lang = f.lang
    AND x.phrase = array_to_string(f.w[1:k], ' ') AND y.phrase = array_to_string(f.w[k+1:], ' ')
), best AS (
  SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM f WHERE size = 3 AND f >= 10) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best JOIN n USING (lang) LEFT JOIN longer USING (lang, phrase)
WHERE best.size = 3 OR longer.f IS NULL OR 100 * longer.f < 50 * a
QUALIFY rank <= 2000"""


ORACLES = {
    "op3_quality_rules": _quality(),
    "op6_secret_scan": _secrets(),
    "op11_collocations": _collocations(),
}
