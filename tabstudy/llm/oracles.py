"""The results of the operators' queries as SQL, where SQL can state them."""

from __future__ import annotations

from tabstudy.llm import lines, merkle, mixing, repetitions, warc

LINES = f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM split
), shared AS (
  SELECT line_key, max(doc_id) AS last_id FROM keyed WHERE length(line_key) >= {lines.MIN_CHARS}
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= {lines.MIN_DOCUMENTS}
), marked AS (
  SELECT k.*, s.line_key IS NOT NULL AND k.doc_id <> s.last_id AS gone
  FROM keyed k LEFT JOIN shared s USING (line_key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def mixing_sql(sweeps: int = mixing.SWEEPS, temper: float = mixing.TEMPER, seed: str = mixing.SEED) -> str:
    """Raking written out: one CTE per margin and sweep."""
    text = "coalesce(text, '')"
    margins = ("source", "lang", "topic")
    steps = [
        f"""described AS (
  SELECT doc_id, source, lang,
         CASE WHEN length({text}) = 0 THEN 'empty'
              WHEN length(regexp_replace({text}, '[^0-9]', '', 'g')) * 500 >= length({text}) THEN 'figures'
              WHEN (length({text}) - length(replace({text}, chr(10), ''))) * 300 >= length({text}) THEN 'short-lined'
              WHEN length({text}) >= 8000 THEN 'long-form' ELSE 'prose' END AS topic,
         len(regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
  FROM documents
)""",
        "cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS cell_tokens FROM described GROUP BY ALL)",
        "w0 AS (SELECT c.*, cell_tokens AS weight, "
        + ", ".join(f"pow(sum(cell_tokens) OVER (PARTITION BY {m}), {temper}) AS t_{m}" for m in margins)
        + " FROM cells c)",
    ]
    last = 0
    for _ in range(sweeps):
        for m in margins:
            total = f"sum(weight) OVER (PARTITION BY {m})"
            steps.append(
                f"w{last + 1} AS (SELECT * REPLACE (CASE WHEN {total} > 0 THEN weight * t_{m} / {total} "
                f"ELSE weight END AS weight) FROM w{last})"
            )
            last += 1
    steps.append(
        "odds AS (SELECT source, lang, topic, CASE WHEN cell_tokens > 0 THEN weight / cell_tokens END AS ratio, "
        f"max(CASE WHEN cell_tokens > 0 THEN weight / cell_tokens END) OVER () AS most FROM w{last})"
    )
    draw = f"('0x' || substr(md5('{seed}|' || doc_id), 1, {mixing.DIGITS}))::BIGINT / pow(16, {mixing.DIGITS})"
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(coalesce(ratio / most, 1), 6) AS probability,
       {draw} < coalesce(ratio / most, 1) AS kept
FROM described d JOIN odds o ON d.source IS NOT DISTINCT FROM o.source
  AND d.lang IS NOT DISTINCT FROM o.lang AND d.topic = o.topic"""
    )


ARCHIVE = f"""
WITH sized AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
last AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last_id FROM sized)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN n >= {warc.LEAST_REVISIT} AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {warc.LEAST_REVISIT} AND page_id < last_id THEN last_id END AS refers_to
FROM last
"""

def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a column of ASCII text, bit by bit."""
    bits = "list_reduce(list_prepend(xor(c, x), range(8)), lambda d, i: xor(d >> 1, 3988292384 * (d & 1)))"
    codes = f"[ascii(ch)::BIGINT FOR ch IN string_split({text}, '')]"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, x: {bits}), 4294967295)"


def leaf_sql(*columns: str) -> str:
    told = [f"coalesce(strlen(({c})::VARCHAR)::VARCHAR || ':' || ({c})::VARCHAR, '-')" for c in columns]
    return "sha256(" + " || ".join(told) + ")"


def tree_sql(name: str, source: str, fanout: int) -> str:
    """CTEs ``<name>_nodes`` (grp, level, pos, digest, n) over leaves (grp, pos, digest, n), and ``<name>_runs`` beside them."""
    run = f"OVER (PARTITION BY grp, level, pos // {fanout} ORDER BY pos ROWS BETWEEN"
    return f"""{name}_nodes AS (
  SELECT grp, 0 AS level, pos, digest, n FROM {source}
  UNION ALL
  SELECT grp, level + 1, pos // {fanout}, sha256(string_agg(digest, '' ORDER BY pos)), (n + {fanout - 1}) // {fanout}
  FROM {name}_nodes WHERE n > 1 GROUP BY grp, level, pos // {fanout}, n
), {name}_runs AS (
  SELECT grp, level, pos,
         coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}_nodes WHERE n > 1
)"""


def climb_sql(name: str, start: str, tree: str, fanout: int) -> str:
    """CTE ``name``: from leaves (key, grp, pos, folded, proof) to the top of their tree, one level per step."""
    return f"""{name} AS (
  SELECT key, grp, 0 AS level, pos, folded, proof FROM {start}
  UNION ALL
  SELECT c.key, c.grp, c.level + 1, c.pos // {fanout}, sha256(r.before || c.folded || r.after), c.proof || r.before || r.after
  FROM {name} c JOIN {tree}_runs r ON c.grp IS NOT DISTINCT FROM r.grp AND c.level = r.level AND c.pos = r.pos
)"""


def merkle_sql(fanout: int = merkle.FANOUT) -> str:
    """The trees level by level from below, then every leaf's way up, first in its source and then over the sources."""
    kept = ("doc_id", "source", "lang", "n_chars")
    even = f"({crc32_sql('doc_id::VARCHAR')}) % 2 = 0"
    tampered = f"CASE WHEN {even} THEN replace(text, chr(10), '') ELSE text END"
    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source AS grp, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n, {leaf_sql(*kept, "text")} AS digest, {leaf_sql(*kept, tampered)} AS found
  FROM documents
), {tree_sql("low", "leaves", fanout)}, subroots AS (
  SELECT grp AS source, 0 AS grp, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, digest
  FROM low_nodes WHERE n = 1
), {tree_sql("high", "subroots", fanout)}, low_start AS (
  SELECT doc_id AS key, grp, pos, found AS folded, '' AS proof FROM leaves
), {climb_sql("low_climb", "low_start", "low", fanout)}, high_start AS (
  SELECT key, 0 AS grp, s.pos, folded, proof
  FROM (SELECT * FROM low_climb QUALIFY row_number() OVER (PARTITION BY key ORDER BY level DESC) = 1) c
  JOIN subroots s ON c.grp IS NOT DISTINCT FROM s.source
), {climb_sql("high_climb", "high_start", "high", fanout)}, top AS (
  SELECT * FROM high_climb QUALIFY row_number() OVER (PARTITION BY key ORDER BY level DESC) = 1
)
SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(t.proof) AS proof_sha256,
       t.folded AS folded_root, t.folded = r.digest AS verified
FROM leaves l JOIN top t ON t.key = l.doc_id JOIN subroots s ON s.source IS NOT DISTINCT FROM l.grp
  JOIN high_nodes r ON r.n = 1
"""


def runs_sql(least_words: int = repetitions.LEAST_WORDS, least_exponent: int = repetitions.LEAST_EXPONENT) -> str:
    """Equal words of a text at every distance, unbroken stretches of them, and of equal stretches the smallest distance."""
    return f"""
WITH marked AS (
  SELECT doc_id, {crc32_sql("doc_id::VARCHAR")} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), planned AS (
  SELECT *, len(words) AS n, (h // 10) % len(words) AS a,
         1 + (len(words) - (h // 10) % len(words)) // (3 + (h // 10) % 8) AS p FROM marked
), spread AS (
  SELECT doc_id, words, h, n, a, p, unnest(range(n)) AS i FROM planned
), tokens AS (
  SELECT doc_id, i, n, words[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM spread
), equal AS (
  SELECT t.doc_id, t.i, t.i - e.i AS q FROM tokens t JOIN tokens e
    ON t.doc_id = e.doc_id AND t.word = e.word AND e.i < t.i AND (t.i - e.i) * {least_exponent} <= t.n
), islands AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal
), stretches AS (
  SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest({least_words}, {least_exponent} * q)
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS told FROM tokens ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
), lists AS (
  SELECT doc_id, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS told
  FROM runs GROUP BY doc_id
)
SELECT m.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
       period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
       sha256(coalesce(l.told, '')) AS runs_sha256, sha256(coalesce(k.told, '')) AS collapsed_sha256
FROM marked m LEFT JOIN lists l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


ORACLES: dict[str, str] = {
    "op1_warc": ARCHIVE,
    "op4_mixing": mixing_sql(),
    "op10_lines": LINES,
    "op11_merkle": merkle_sql(),
    "op12_runs": runs_sql(),
}
