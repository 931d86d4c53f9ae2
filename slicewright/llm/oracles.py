"""DuckDB SQL for operators whose rows SQL can express, written over the raw tables.

CRC-32 is taken byte by byte in SQL: ``_CRC_TABLE`` is a CTE ``crc`` of its 256
steps, ``_crc32`` folds a list of bytes.
"""

from __future__ import annotations

from . import fingerprint, sharding, simhash

_CRC_TABLE = """crc AS (
  SELECT list(list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) ORDER BY i) AS steps
  FROM range(256) r(i)
)"""


def _crc32(bytes_: str) -> str:
    return f"xor(list_reduce({bytes_}, lambda c, b: xor(crc.steps[xor(c & 255, b) + 1], c >> 8), 4294967295), 4294967295)"


def _ascii(text: str) -> str:
    """Bytes of a text without other characters."""
    return f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"


#: Every 20 bits of the SHA-1 are four base-32 digits.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS kept FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       translate(array_to_string(list_transform(range(8), lambda i: to_base(('0x' || substr(h, 5 * i + 1, 5))::BIGINT, 32, 4)), ''),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM k"""

_MASK64 = "18446744073709551616::UHUGEINT"
_KEY_LIST = "[" + ", ".join(f"{k}::UHUGEINT" for k in sharding._keys(sharding.SEED)) + "]"

#: One Feistel round a step; a number is placed when its last round leaves it below n, else it walks on.
SHARDING = f"""
WITH RECURSIVE {_CRC_TABLE},
r AS (
  SELECT doc_id, (coalesce(strlen(text), 0) + 8)::BIGINT AS size,
         {_crc32("list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)")}::BIGINT AS text_crc32
  FROM documents, crc
), m AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS row_number FROM r),
d AS (SELECT n, (greatest(1, (len(to_binary(greatest(1, n - 1))) + 1) // 2))::BIGINT AS half FROM (SELECT count(*) AS n FROM r)),
f AS (
  SELECT row_number, 0 AS round, row_number >> half AS hi, row_number & ((1::BIGINT << half) - 1) AS lo FROM m, d
  UNION ALL
  SELECT row_number, round + 1, lo, xor(hi, (xor(z, z >> 31) & ((1::UBIGINT << half::UBIGINT) - 1))::BIGINT)
  FROM (
    SELECT *, ((xor(y, y >> 27)::UHUGEINT * 10723151780598845931::UHUGEINT) % {_MASK64})::UBIGINT AS z
    FROM (
      SELECT *, ((xor(x, x >> 30)::UHUGEINT * 13787848793156543929::UHUGEINT) % {_MASK64})::UBIGINT AS y
      FROM (SELECT f.*, half, ((lo::UHUGEINT + {_KEY_LIST}[round % {sharding.ROUNDS} + 1]) % {_MASK64})::UBIGINT AS x
            FROM f, d WHERE round = 0 OR round % {sharding.ROUNDS} <> 0 OR (hi << half) + lo >= n)
    )
  )
), p AS (SELECT row_number, (hi << half) + lo AS place FROM f, d WHERE round > 0 AND round % {sharding.ROUNDS} = 0 AND (hi << half) + lo < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place % {sharding.SHARDS})::INTEGER AS shard, (place // {sharding.SHARDS})::BIGINT AS slot,
       NULL::INTEGER AS grown_shard, row_number::BIGINT AS row_number, place::BIGINT AS place
FROM m JOIN p USING (row_number)"""

#: One turn a step: the best cost, audit and text for each state of the roles; inserts go before a turn's own edit.
CONVERSATIONS = rf"""
WITH RECURSIVE {_CRC_TABLE},
o AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32(_ascii("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"))} % 20 AS kind
  FROM conversations, crc
), a AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN []::INTEGER[] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM o
), k AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k, left(role, 1) AS c FROM a),
j AS (
  SELECT *, lag(c) OVER (PARTITION BY conv ORDER BY k) || c AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM k
), counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(k) AS n,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (k > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM j GROUP BY conv
), inserted(state, later, marks, roles) AS (
  VALUES ('', '', '', ''), ('s', 's', '', ''), ('u', 'u', '', ''), ('a', 'a', '', ''), ('', 'u', 'I', 'user'), ('s', 'u', 'I', 'user'), ('a', 'u', 'I', 'user'),
         ('u', 'a', 'I', 'assistant'), ('', 'a', 'II', 'both'), ('s', 'a', 'II', 'both')
), gone AS (
  SELECT state, later, marks, 5 * len(marks) AS price,
         CASE roles WHEN '' THEN '' WHEN 'both' THEN chr(10) || 'user:' || chr(10) || 'assistant:' ELSE chr(10) || roles || ':' END AS added
  FROM inserted
), best AS (
  SELECT DISTINCT conv, 0::BIGINT AS k, '' AS state, {{'cost': 0::BIGINT, 'audit': '', 'out': ''}} AS b FROM o
  UNION ALL
  SELECT s.conv, s.k + 1, e.state, min({{'cost': s.b.cost + g.price + e.cost, 'audit': s.b.audit || g.marks || e.mark, 'out': s.b.out || g.added || e.added}})
  FROM best s JOIN gone g ON g.state = s.state JOIN j ON j.conv = s.conv AND j.k = s.k + 1,
  LATERAL (
    SELECT g.later AS state, 2 AS cost, 'D' AS mark, '' AS added
    UNION ALL
    SELECT CASE g.later WHEN 'u' THEN 'a' ELSE 'u' END, CASE j.fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R',
           chr(10) || CASE g.later WHEN 'u' THEN 'assistant:' ELSE 'user:' END || j.text
    WHERE j.fault NOT IN ('blank', 'duplicate')
    UNION ALL
    SELECT j.c, CASE j.fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K', chr(10) || j.role || ':' || j.text
    WHERE j.fault NOT IN ('blank', 'duplicate') AND ((j.c = 's' AND g.later = '') OR (j.c = 'u' AND g.later <> 'u') OR (j.c = 'a' AND g.later = 'u'))
  ) e
  GROUP BY s.conv, s.k + 1, e.state
), ended AS (
  SELECT s.conv, min({{'cost': s.b.cost + g.price, 'audit': s.b.audit || g.marks, 'out': s.b.out || g.added}}) AS b
  FROM best s JOIN gone g ON g.state = s.state AND g.later IN ('', 'a') LEFT JOIN counts n ON n.conv = s.conv
  WHERE s.k = coalesce(n.n, 0) GROUP BY s.conv
)
SELECT i.conv_id, coalesce(n.gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0)::BIGINT AS blank, coalesce(n.duplicate, 0)::BIGINT AS duplicate,
       coalesce(n.truncated, 0)::BIGINT AS truncated, coalesce(n.illegal, 0)::BIGINT AS illegal, e.b.cost::BIGINT AS cost, e.b.audit AS audit,
       sha256(substr(e.b.out, 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM o) i JOIN ended e ON e.conv = i.conv LEFT JOIN counts n ON n.conv = i.conv"""


def _field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({name}::VARCHAR) || ':' || {name} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(f) for f in ('doc_id', 'source', 'lang', 'n_chars'))} || {_field(text)})"


def _tree(name: str, leaves: str) -> str:
    """A CTE of all nodes (tree, level, idx, n, digest) over ``leaves`` (tree, idx, n, digest)."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, idx, n, digest FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 8, n
)"""


def _beside(name: str, nodes: str) -> str:
    """A CTE of the siblings before and after each node of a run."""
    run = "(PARTITION BY tree, level, idx // 8 ORDER BY idx ROWS BETWEEN"
    return f"""{name} AS (
  SELECT tree, level, idx, coalesce(string_agg(digest, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {nodes} WHERE n > 1
)"""


MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('text')} AS digest, {_leaf('lowered')} AS lowered_digest,
         coalesce({_crc32(_ascii('doc_id::VARCHAR'))} % 3 = 0, false) AS hit
  FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents), crc
), leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM d),
{_tree('nodes', 'leaves')},
tops AS (SELECT '' AS tree, tree AS of, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n, digest FROM nodes WHERE n = 1),
{_tree('upper_nodes', 'tops')},
{_beside('near', 'nodes')},
{_beside('upper_near', 'upper_nodes')},
steps AS (
  SELECT leaves.tree, leaves.idx, near.level, near.l, near.r FROM leaves JOIN near ON near.tree = leaves.tree AND near.idx = leaves.idx // (8 ** near.level)::BIGINT
  UNION ALL
  SELECT leaves.tree, leaves.idx, 1000 + u.level, u.l, u.r FROM leaves JOIN tops ON tops.of = leaves.tree JOIN upper_near u ON u.idx = tops.idx // (8 ** u.level)::BIGINT
), paths AS (SELECT tree, idx, list(l || ',' || r ORDER BY level) AS path, string_agg(l || r, '' ORDER BY level) AS siblings FROM steps GROUP BY tree, idx),
found AS (
  SELECT leaves.*, tops.digest AS subroot, (SELECT digest FROM upper_nodes WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(coalesce(path, []::VARCHAR[]), lambda h, x: sha256(split_part(x, ',', 1) || h || split_part(x, ',', 2)), CASE WHEN hit THEN lowered_digest ELSE leaves.digest END) AS folded_root,
         list_sum(list_transform(range(coalesce((SELECT max(level) FROM nodes WHERE nodes.tree = leaves.tree), 0) + 1), lambda t: leaves.idx // (8 ** t)::BIGINT)) AS log_position
  FROM leaves JOIN tops ON tops.of = leaves.tree LEFT JOIN paths ON paths.tree = leaves.tree AND paths.idx = leaves.idx
)
SELECT doc_id, digest AS leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified, log_position::BIGINT AS log_position
FROM found"""

def _tokens(table: str, key: str) -> str:
    split = r"string_split_regex(lower(coalesce(text, '')), '[\x00-/:-@\[-`{-\x7F]+')"
    return f"SELECT {key}, text, list_filter({split}, lambda w: w <> '') AS tokens FROM (SELECT DISTINCT {key}, coalesce(text, '') AS text FROM {table})"


#: Diagonals are those on which all the tokens of some mask's place are equal; any two sums of a diagonal are then tried as the ends of a stretch.
DECONTAMINATE = rf"""
WITH i AS (SELECT row_number() OVER () AS i, item_id, tokens, len(tokens) AS n FROM ({_tokens("benchmark", "item_id")}) WHERE len(tokens) > 0),
d AS (SELECT row_number() OVER () AS d, doc_id, tokens, len(tokens) AS n FROM ({_tokens("documents", "doc_id")})),
it AS (SELECT i, n, unnest(range(n)) AS pos, unnest(tokens) AS w FROM i),
dt AS (SELECT d, unnest(range(n)) AS pos, unnest(tokens) AS w FROM d),
i4 AS (SELECT i, pos, w AS a, lead(w, 3) OVER q AS b, lead(w, 6) OVER q AS c, lead(w, 9) OVER q AS e FROM it WHERE n >= 13 WINDOW q AS (PARTITION BY i ORDER BY pos)),
d4 AS (SELECT d, pos, w AS a, lead(w, 3) OVER q AS b, lead(w, 6) OVER q AS c, lead(w, 9) OVER q AS e FROM dt WINDOW q AS (PARTITION BY d ORDER BY pos)),
s AS (SELECT i, n, pos, w, n // 5 + 1 AS step, pos % (n // 5 + 1) AS class FROM it WHERE n < 13),
hits AS (
  SELECT DISTINCT i, d, d4.pos - i4.pos AS diagonal FROM i4 JOIN d4 USING (a, b, c, e)
  UNION
  SELECT s.i, dt.d, dt.pos - s.pos FROM s JOIN dt USING (w)
  GROUP BY s.i, dt.d, dt.pos - s.pos, s.class, s.n, s.step HAVING count(*) = ceil((s.n - s.class) / s.step)
), m AS (
  SELECT h.*, i.n AS n_item, greatest(0, -diagonal) AS low, least(i.n, d.n - diagonal) AS high,
         list_transform(range(greatest(0, -diagonal), least(i.n, d.n - diagonal)), lambda p: CASE WHEN i.tokens[p + 1] = d.tokens[p + diagonal + 1] THEN 1 ELSE 0 END) AS same
  FROM hits h JOIN i USING (i) JOIN d USING (d)
), c AS (SELECT *, list_sum(same) AS agreed FROM m),
sums AS (
  SELECT i, d, diagonal, low, 0 AS k, 0 AS matches FROM c WHERE agreed * 5 < n_item * 4 AND n_item >= 13
  UNION ALL
  SELECT i, d, diagonal, low, k, sum(x) OVER (PARTITION BY i, d, diagonal ORDER BY k)
  FROM (SELECT i, d, diagonal, low, unnest(range(1, len(same) + 1)) AS k, unnest(same) AS x FROM c WHERE agreed * 5 < n_item * 4 AND n_item >= 13)
), best AS (
  SELECT y.i, y.d, y.diagonal, y.low, max({{'length': y.k - x.k, 'first': -x.k, 'agreed': y.matches - x.matches}}) AS s
  FROM sums x JOIN sums y ON x.i = y.i AND x.d = y.d AND x.diagonal = y.diagonal AND y.k - x.k >= 13 AND (y.matches - x.matches) * 5 >= (y.k - x.k) * 4
  GROUP BY y.i, y.d, y.diagonal, y.low
), found AS (
  SELECT i, d, diagonal, low AS b, high AS e, agreed FROM c WHERE agreed * 5 >= n_item * 4
  UNION ALL
  SELECT i, d, diagonal, low - s.first, low - s.first + s.length, s.agreed FROM best
)
SELECT doc_id, item_id, (b + diagonal)::INTEGER AS doc_start, (e + diagonal)::INTEGER AS doc_end, b::INTEGER AS item_start, e::INTEGER AS item_end, agreed::INTEGER AS matching
FROM found JOIN i USING (i) JOIN d USING (d)"""

#: The five multipliers of XXH64 (fixed values).
_P1, _P2, _P3, _P4, _P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261


def _mod(x: str) -> str:
    """A sum or product of 64-bit numbers, held in 128 bits, as 64 bits."""
    return f"(({x}) % {_MASK64})"


def _turned(x: str, bits: int) -> str:
    """A 64-bit number turned left."""
    return f"(({x} * {1 << bits}::UHUGEINT) % {_MASK64} + {x} // {1 << (64 - bits)}::UHUGEINT)"


def _round(acc: str, lane: str) -> str:
    return _mod(f"{_turned(_mod(f'{acc} + {lane} * {_P2}::UHUGEINT % {_MASK64}'), 31)} * {_P1}::UHUGEINT")


def _lane(at: str, size: int) -> str:
    """Little-endian number at a byte of ``swapped``, the text's hex digits with those of each byte exchanged."""
    return f"('0x' || reverse(substr(swapped, 2 * ({at}) + 1, {2 * size})))::UBIGINT::UHUGEINT"


def _stripes(k: int, start: int) -> str:
    lanes = f"list_transform(range(size // 32), lambda s: {_lane(f'32 * s + {8 * k}', 8)})"
    return f"list_reduce({lanes}, lambda v, x: {_round('v', 'x')}, {start % 2**64}::UHUGEINT)"


def _xxh64(rows: str, seed: int) -> str:
    """Query of (shingle, h) over ``rows`` (shingle): unsigned XXH64 of its UTF-8 bytes."""
    def eights(h, x):
        return _mod(f"{_turned(f'xor({h}, {_round("0::UHUGEINT", x)})', 27)} * {_P1}::UHUGEINT + {_P4}::UHUGEINT")

    merged = "h0"
    steps = [f"SELECT *, {_mod(' + '.join(_turned(f'v{k}', r) for k, r in enumerate((1, 7, 12, 18))))} AS m0 FROM v"]
    for k in range(4):
        steps.append(f"SELECT *, {_mod(f'xor(m{k}, {_round("0::UHUGEINT", f"v{k}")}) * {_P1}::UHUGEINT + {_P4}::UHUGEINT')} AS m{k + 1} FROM ({steps[-1]})")
    start = f"CASE WHEN size >= 32 THEN m4 ELSE {(seed + _P5) % 2**64}::UHUGEINT END + size::UHUGEINT"
    steps.append(f"SELECT *, {_mod(start)} AS {merged} FROM ({steps[-1]})")
    by_eight = f"list_transform(range(size % 32 // 8), lambda s: {_lane('size // 32 * 32 + 8 * s', 8)})"
    steps.append(f"SELECT *, list_reduce({by_eight}, lambda h, x: {eights('h', 'x')}, h0) AS h1 FROM ({steps[-1]})")
    four = _mod(f"{_turned(_mod(f'xor(h1, {_lane("size // 8 * 8", 4)} * {_P1}::UHUGEINT % {_MASK64})'), 23)} * {_P2}::UHUGEINT + {_P3}::UHUGEINT")
    steps.append(f"SELECT *, CASE WHEN size % 8 >= 4 THEN {four} ELSE h1 END AS h2 FROM ({steps[-1]})")
    one = _mod(f"{_turned(f'xor(h, x * {_P5}::UHUGEINT % {_MASK64})', 11)} * {_P1}::UHUGEINT")
    steps.append(f"SELECT *, list_reduce(list_transform(range(size % 4), lambda s: {_lane('size // 4 * 4 + s', 1)}), lambda h, x: {one}, h2) AS h3 FROM ({steps[-1]})")
    steps.append(f"SELECT *, {_mod(f'xor(h3, h3 >> 33) * {_P2}::UHUGEINT')} AS h4 FROM ({steps[-1]})")
    steps.append(f"SELECT *, {_mod(f'xor(h4, h4 >> 29) * {_P3}::UHUGEINT')} AS h5 FROM ({steps[-1]})")
    starts = (seed + _P1 + _P2, seed + _P2, seed, seed - _P1)
    held = ", ".join(f"{_stripes(k, x)} AS v{k}" for k, x in enumerate(starts))
    return f"""WITH b AS (SELECT shingle, strlen(shingle) AS size, regexp_replace(hex(encode(shingle)), '(.)(.)', '\\2\\1', 'g') AS swapped FROM {rows}),
  v AS (SELECT *, {held} FROM b)
  SELECT shingle, xor(h5, h5 >> 32)::UBIGINT AS h FROM ({steps[-1]})"""


#: All pairs of distinct fingerprints are compared, and links followed until nothing new is reached.
SIMHASH = rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), o AS (
  SELECT row, unnest(list_transform(range(greatest(1, len(words) - {simhash.SHINGLE - 1})), lambda i: array_to_string(words[i + 1:i + {simhash.SHINGLE}], ' '))) AS shingle
  FROM w WHERE len(words) > 0
), x AS (SELECT DISTINCT shingle FROM o), hashed AS ({_xxh64("x", simhash.SEED)}),
ones AS (SELECT row, count(*) AS n, {", ".join(f"sum((h >> {k}) & 1) AS b{k}" for k in range(64))} FROM o JOIN hashed USING (shingle) GROUP BY row),
f AS (SELECT doc_id, coalesce({" + ".join(f"CASE WHEN 2 * b{k} > n THEN {1 << k}::UBIGINT ELSE 0::UBIGINT END" for k in range(64))}, 0::UBIGINT)::UBIGINT AS fp FROM w LEFT JOIN ones USING (row)),
g AS (SELECT fp, min(doc_id) AS lowest FROM f GROUP BY fp),
near AS (SELECT a.fp AS a, b.fp AS b FROM g a JOIN g b ON bit_count(xor(a.fp, b.fp)) <= {simhash.MAX_BITS}),
reach AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON n.a = r.b),
named AS (SELECT r.a AS fp, min(g.lowest) AS component_id FROM reach r JOIN g ON g.fp = r.b GROUP BY r.a)
SELECT f.doc_id, lower(lpad(to_base((fp >> 32)::BIGINT, 16, 8) || to_base((fp & 4294967295)::BIGINT, 16, 8), 16, '0')) AS fingerprint, named.component_id
FROM f JOIN named USING (fp)"""

def _shingle_hash(words: list[str], rows: str) -> str:
    """Query that adds ``h``, the 32-bit hash of a shingle, to rows that hold its words' hashes, NULL where it is shorter."""
    out = f"SELECT *, 0::UHUGEINT AS y0 FROM {rows}"
    for k, w in enumerate(words):
        out = f"SELECT *, {_mod(f'xor(y{k}, {w}::UHUGEINT) * {int(fingerprint._STEP)}::UHUGEINT')} AS z{k} FROM ({out})"
        out = f"SELECT *, CASE WHEN {w} IS NULL THEN y{k} ELSE xor(z{k}, z{k} >> 29) END AS y{k + 1} FROM ({out})"
    last = f"y{len(words)}"
    out = f"SELECT *, {_mod(f'xor({last}, {last} >> 32) * 13787848793156543929::UHUGEINT')} AS last FROM ({out})"
    return f"SELECT *, (xor(last, last >> 31) >> 32)::BIGINT AS h FROM ({out})"


def _likeness(a: str, b: str, of: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    total = f"len({a}) + len({b}) - {both}" if of == "both" else f"len({a})"
    return f"CASE WHEN {total} = 0 THEN 1.0::DOUBLE ELSE {both}::DOUBLE / ({total}) END"


_WORDS = [f"w{k}" for k in range(fingerprint.SHINGLE)]

FINGERPRINTS = rf"""
WITH d AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS row, count(*) OVER () AS n
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
), e AS (
  SELECT d.*, d.row % d.n + 1 AS after, left(d.text, length(d.text) - length(d.text) // 4) || left(x.text, length(d.text) // 4) AS edited
  FROM d JOIN d x ON x.row = d.row % d.n + 1
), t AS (
  SELECT row, kind, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS words
  FROM (SELECT row, 0 AS kind, text FROM e UNION ALL SELECT row, 1, edited FROM e)
), u AS (SELECT row, kind, len(words) AS size, unnest(range(len(words))) AS pos, unnest(words) AS shingle FROM t),
x AS (SELECT DISTINCT shingle FROM u), hashed AS ({_xxh64("x", 0)}),
q AS (
  SELECT row, kind, size, pos, h AS w0, {", ".join(f"lead(h, {k}) OVER q AS w{k}" for k in range(1, fingerprint.SHINGLE))}
  FROM u JOIN hashed USING (shingle) WINDOW q AS (PARTITION BY row, kind ORDER BY pos)
), c AS (SELECT DISTINCT row, kind, h FROM ({_shingle_hash(_WORDS, f"(SELECT * FROM q WHERE pos <= greatest(0, size - {fingerprint.SHINGLE}))")})),
k AS (SELECT row, kind, list(h ORDER BY h) AS hashes FROM c WHERE h < {2**32 // fingerprint.SCALE} GROUP BY row, kind),
s AS (SELECT t.row, t.kind, coalesce(k.hashes, []) AS hashes, coalesce(array_to_string(list_transform(k.hashes, lambda h: lower(to_base(h, 16, 8))), ''), '') AS hex FROM t LEFT JOIN k USING (row, kind))
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, a.hex AS fingerprint, b.hex AS edited_fingerprint,
       {_likeness("a.hashes", "b.hashes", "both")} AS near_edited, {_likeness("a.hashes", "c.hashes", "both")} AS near_next, {_likeness("a.hashes", "c.hashes", "a")} AS held_by_next
FROM e JOIN s a ON a.row = e.row AND a.kind = 0 JOIN s b ON b.row = e.row AND b.kind = 1 JOIN s c ON c.row = e.after AND c.kind = 0"""

ORACLES = {"op2_simhash": SIMHASH, "op6_sharding": SHARDING, "op7_warc": WARC, "op8_fingerprint": FINGERPRINTS, "op9_decontaminate": DECONTAMINATE, "op12_conversations": CONVERSATIONS, "op13_manifest": MANIFEST}

__all__ = ["ORACLES"]
