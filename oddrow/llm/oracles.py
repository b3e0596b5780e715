"""SQL (DuckDB) that gives the same rows as a query of this subpackage."""

from __future__ import annotations

from oddrow.llm import rules

SPACE = r"\x20\x09-\x0D"


def _rules() -> str:
    stops = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)
    tests = []
    for rule in rules.THRESHOLDS:
        unit = rule.per or "1"
        if rule.low is not None:
            tests.append(f"{rule.measure} >= {rule.low} * {unit}")
        if rule.high is not None:
            tests.append(f"{rule.measure} <= {rule.high} * {unit}")
    windows = "list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])"
    return f"""
    WITH base AS (
      SELECT doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
          lambda s: regexp_matches(s, '[^{SPACE}]')) AS lines
      FROM documents),
    grams AS (
      SELECT doc_id, unnest({windows}) AS g, unnest(range(1, len(w) - 1)) AS i FROM base),
    twice AS (
      SELECT doc_id, i FROM grams
      QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    covered AS (
      SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS s(k)
      GROUP BY doc_id),
    made AS (
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^{rules.SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS BIGINT) AS n_capitals,
        CAST(length(regexp_replace(t, '[^\\p{{Nd}}]', '', 'g')) AS BIGINT) AS n_digits,
        len(lines) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        len(list_intersect(list_distinct(w), [{stops}])) AS n_stop_words
      FROM base),
    judged AS (
      SELECT made.*, coalesce(n, 0) AS n_repeat_words,
        n_words < {rules.MIN_WORDS} OR 100 * coalesce(n, 0) > 50 * n_words AS base_failed
      FROM made LEFT JOIN covered USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND {" AND ".join(tests)} AS kept
    FROM judged"""


_CHAT = r"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations
      UNION ALL SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok'
      FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
    sized AS (
      SELECT *, length('<|im_start|>' || '<|im_end|>') + 2
          + length(replace(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'), chr(10), '<n|'))
          + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS chars,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
        count(*) OVER (PARTITION BY conv_id) AS n
      FROM turns),
    summed AS (
      SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS until FROM sized)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
      CAST(sum(until) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
    FROM summed GROUP BY conv_id"""

_EXACT_DEDUP = """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      coalesce(doc_id = max(doc_id) OVER same, max(doc_id) OVER same IS NULL) AS kept,
      sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

_NGRAM_JOIN = f"""
    WITH RECURSIVE cut AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{SPACE}]+') AS w
      FROM documents),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3),
          lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
      FROM cut),
    items AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    pairs AS (
      SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS m, any_value(y.n) AS n,
        count(*) AS common
      FROM items x JOIN items y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
    links AS MATERIALIZED (
      SELECT a, b FROM pairs WHERE 100 * common >= 75 * (m + n - common)),
    reach AS (
      SELECT doc_id, doc_id AS other FROM sets
      UNION SELECT reach.doc_id, b FROM reach JOIN links ON other = a)
    SELECT doc_id, any_value(len(s)) AS n_shingles, min(other) AS component_id
    FROM sets JOIN reach USING (doc_id) GROUP BY doc_id"""

_LOWER = """translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
LETTERS_AND_DIGITS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_DECONTAMINATE = f"""
    WITH words AS (
      SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all({_LOWER}, '{LETTERS_AND_DIGITS}') AS w
      FROM documents),
    items AS (
      SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
        regexp_extract_all({_LOWER}, '{LETTERS_AND_DIGITS}') AS w
      FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS n,
        array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS g
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k
            FROM items WHERE len(w) > 0)),
    places AS (
      SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k
            FROM words, (SELECT DISTINCT n FROM windows))),
    found AS MATERIALIZED (SELECT r, k, n, item_id FROM places JOIN windows USING (n, g)),
    hits AS (
      SELECT r, count(DISTINCT p) AS n_hit
      FROM (SELECT DISTINCT r, unnest(range(k, k + n)) AS p FROM found) GROUP BY r),
    named AS (
      SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
      coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
      n_hit IS NOT NULL AS contaminated
    FROM words LEFT JOIN hits USING (r) LEFT JOIN named USING (r)"""

_IMPORTANCE = f"""
    WITH docs AS (
      SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all({_LOWER}, '{LETTERS_AND_DIGITS}') AS w
      FROM documents),
    own AS MATERIALIZED (
      SELECT r, g, count(*) AS n FROM (SELECT r, unnest(w) AS g FROM docs) GROUP BY r, g),
    wanted AS MATERIALIZED (
      SELECT unnest(regexp_extract_all({_LOWER}, '{LETTERS_AND_DIGITS}')) AS g FROM benchmark),
    crc_table AS (
      SELECT list(c ORDER BY i) AS t
      FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
              lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
            FROM range(256) AS x(i))),
    words AS (
      SELECT g, hex(encode(g)) AS h FROM (SELECT g FROM own UNION SELECT g FROM wanted)),
    hashed AS MATERIALIZED (
      SELECT g, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
          list_transform(range(0, len(h) // 2),
            lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT))),
          lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 10000 AS b
      FROM words, crc_table),
    counted AS (
      SELECT b, CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t
      FROM (SELECT g, n AS s, 0 AS t FROM own UNION ALL SELECT g, 0, 1 FROM wanted)
      JOIN hashed USING (g) GROUP BY b),
    gained AS (
      SELECT b, CAST(floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))
        / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
      FROM counted),
    weighed AS (
      SELECT r, CAST(sum(n * gain) AS BIGINT) AS weight
      FROM own JOIN hashed USING (g) JOIN gained USING (b) GROUP BY r),
    scored AS (
      SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' ||
          sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5::DOUBLE)
          / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM docs LEFT JOIN weighed USING (r)),
    placed AS (
      SELECT *, n_features >= 20 AS fits,
        CAST(count(*) FILTER (n_features >= 20) OVER () AS BIGINT) AS n,
        row_number() OVER (PARTITION BY n_features >= 20
          ORDER BY score DESC, doc_id ASC NULLS LAST, n_features) AS place
      FROM scored)
    SELECT doc_id, n_features, weight, score,
      CASE WHEN fits AND place <= 10 * n // 100 THEN place END AS rank
    FROM placed"""

LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_SHARE = "CAST(1 + (1000000000::HUGEINT * ({n} + 1)) // ({words} + v) AS BIGINT)"

_DIVERGENCE = f"""
    WITH docs AS (
      SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all({_LOWER}, '{LETTERS}') AS w
      FROM documents),
    counts AS MATERIALIZED (
      SELECT r, lang, source, term, count(*) AS n
      FROM (SELECT r, lang, source, unnest(w) AS term FROM docs) GROUP BY ALL),
    kept AS MATERIALIZED (
      SELECT lang, term, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY lang, term
      HAVING count(*) >= 3),
    langs AS (
      SELECT lang, count(*) AS v, CAST(sum(total) AS BIGINT) AS words FROM kept GROUP BY lang),
    own AS MATERIALIZED (
      SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n, any_value(total) AS total
      FROM counts JOIN kept USING (lang, term) GROUP BY lang, source, term),
    groups AS MATERIALIZED (
      SELECT g.lang, g.source, coalesce(v, 0) AS v, langs.words AS lang_words,
        coalesce(o.words, 0) AS words
      FROM (SELECT DISTINCT lang, source FROM docs) AS g LEFT JOIN langs USING (lang)
      LEFT JOIN (SELECT lang, source, CAST(sum(n) AS BIGINT) AS words FROM own
                 GROUP BY lang, source) AS o USING (lang, source)),
    dense AS MATERIALIZED (
      SELECT groups.lang, groups.source, kept.term,
        {_SHARE.format(n="coalesce(n, 0)", words="words")} AS p
      FROM groups JOIN kept USING (lang) LEFT JOIN own USING (lang, source, term)),
    pairs AS (
      SELECT lang, a.source, b.source AS item,
        CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
      FROM dense AS a JOIN dense AS b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
    all_pairs AS (
      SELECT lang, a.source, b.source AS item, coalesce(value, 0) AS value
      FROM groups AS a JOIN groups AS b USING (lang)
      LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND item = b.source
      WHERE a.source <> b.source),
    terms AS (
      SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value
      FROM (SELECT own.lang, own.source, term, {_SHARE.format(n="n", words="words")} AS p,
              {_SHARE.format(n="total", words="lang_words")} AS q
            FROM own JOIN groups USING (lang, source)) WHERE p > q)
    SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part
            ORDER BY value DESC, item) AS rank
          FROM (SELECT *, 'pair' AS part FROM all_pairs
                UNION ALL SELECT *, 'term' FROM terms))
    WHERE part = 'pair' OR rank <= 200"""

ORACLES: dict[str, str] = {
    "op1_ngram_join": _NGRAM_JOIN,
    "op6_rules": _rules(),
    "op7_chat": _CHAT,
    "op8_exact_dedup": _EXACT_DEDUP,
    "op11_decontaminate": _DECONTAMINATE,
    "op12_importance": _IMPORTANCE,
    "op13_divergence": _DIVERGENCE,
}
