"""DuckDB SQL of the queries on spelling variants and on the Merkle manifest: plain SQL over whole tables."""

from __future__ import annotations

#: CRC-32 by its table of 256 remainders.
_REMAINDERS = "rem AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t)"
LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
#: Levels of a language and of the subroots that the SQL unrolls: 8^7 rows of a language, 8^3 languages.
LEVELS, CROWN = 7, 3


def _crc(text: str) -> str:
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce({octets}, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295)"


SPELLING = rf"""
WITH RECURSIVE {_REMAINDERS},
runs AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' AS id, unnest(regexp_extract_all(translate(text, {LETTERS}), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
each AS (SELECT id, run, count(*) AS times FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, times, {_crc('(id || run)')} AS h FROM each, rem),
cut AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
without AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM without a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM without a JOIN words b ON a.rest = b.word),
ranked AS (
  SELECT near.word, other, w.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, other) AS place
  FROM near JOIN words w ON w.word = other),
forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
  FROM words LEFT JOIN ranked ON ranked.word = words.word AND place = 1),
walk(word, stop) AS (
  SELECT word, word FROM forms UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.stop WHERE forms.form IS NOT NULL),
ends AS (SELECT walk.word, walk.stop AS root FROM walk JOIN forms ON forms.word = walk.stop WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""


def _leaf(text: str) -> str:
    parts = (f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({' || '.join(parts)})"


def _climb(name: str, levels: int) -> str:
    """Levels ``<name>1`` … over ``<name>0`` (key, p, h); a key whose level has one node ends there."""
    return ",\n".join(
        f"{name}{k + 1} AS (SELECT key, p // 8 AS p, sha256(string_agg(h, '' ORDER BY p)) AS h FROM {name}{k} "
        f"WHERE key IN (SELECT key FROM {name}{k} GROUP BY key HAVING count(*) > 1) GROUP BY key, p // 8)"
        for k in range(levels)
    )


def _beside(name: str, levels: int) -> str:
    """``<name>s_``: (key, k, p, l, r) the siblings of each node that has a parent."""
    run = "PARTITION BY key, p // 8 ORDER BY p ROWS BETWEEN"
    return f"{name}s_ AS (" + " UNION ALL ".join(
        f"SELECT key, {k} AS k, p, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
        f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k} WHERE key IN (SELECT key FROM {name}{k + 1})"
        for k in range(levels)
    ) + ")"


def _tops(name: str, levels: int) -> str:
    """``<name>t_``: (key, h) the last node of each key."""
    return f"{name}t_ AS (SELECT key, arg_max(h, k) AS h FROM ({' UNION ALL '.join(f'SELECT key, {k} AS k, h FROM {name}{k} WHERE p = 0' for k in range(levels + 1))}) GROUP BY key)"


def _fold(levels: list[tuple[str, str, int]]) -> str:
    """Steps from ``f0`` (…, folded, proof): each level of a tree (name, column of its key and of its place, number)."""
    steps = []
    for i, (name, at, k) in enumerate(levels):
        key, place = at.split(" ")
        steps.append(
            f"f{i + 1} AS (SELECT f.* REPLACE (CASE WHEN l IS NULL THEN folded ELSE sha256(l || folded || r) END AS folded, proof || coalesce(l || r, '') AS proof) "
            f"FROM f{i} f LEFT JOIN {name}s_ s ON s.key = f.{key} AND s.k = {k} AND s.p = f.{place} // {8**k})"
        )
    return ",\n".join(steps)


MANIFEST = f"""
WITH {_REMAINDERS},
given AS (
  SELECT doc_id, coalesce(':' || lang, '') AS lkey, {_leaf('text')} AS leaf,
         CASE WHEN {_crc('doc_id::VARCHAR')} % 3 = 0 THEN {_leaf(f'translate(text, {LETTERS})')} END AS low
  FROM documents, rem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lkey ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM given),
a0 AS (SELECT lkey AS key, pos AS p, leaf AS h FROM ranked),
{_climb('a', LEVELS)},
{_beside('a', LEVELS)},
{_tops('a', LEVELS)},
c0 AS (SELECT 'root' AS key, row_number() OVER (ORDER BY key) - 1 AS p, h, key AS lkey FROM at_),
{_climb('c', CROWN)},
{_beside('c', CROWN)},
{_tops('c', CROWN)},
f0 AS (
  SELECT ranked.doc_id, leaf, lkey, pos, 'root' AS rkey, c0.p AS lpos, c0.h AS subroot, ct_.h AS root, coalesce(low, leaf) AS folded, '' AS proof
  FROM ranked JOIN c0 USING (lkey) CROSS JOIN ct_),
{_fold([*(('a', 'lkey pos', k) for k in range(LEVELS)), *(('c', 'rkey lpos', k) for k in range(CROWN))])}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM f{LEVELS + CROWN}
"""
