"""DuckDB statements for the queries that SQL can express."""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat_ws(':', CAST(doc_id AS VARCHAR), text)) AS place
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM s),
w AS (SELECT *, CAST(no % 3 + 1 AS BIGINT) AS weight, source_size * 3 AS most, sum(source_size) OVER () AS words FROM n),
o AS (
  SELECT *, (words - coalesce(sum(most) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
            >= most * sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full
  FROM w WINDOW r AS (ORDER BY CAST(most AS DOUBLE) / weight, no)),
p AS (
  SELECT *, CAST(words - sum(CASE WHEN is_full THEN most ELSE 0 END) OVER () AS DOUBLE)
            / CAST(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS DOUBLE) AS part
  FROM o),
t AS (SELECT source, no, source_size, CASE WHEN is_full THEN CAST(most AS DOUBLE) ELSE part * weight END AS target FROM p),
l AS (
  SELECT d.doc_id, d.size, t.no, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
         row_number() OVER () AS r,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY place, doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
-- the schedule: blocks of 256 words, their slots at reversed bits
b AS (
  SELECT no, source_size, goal // source_size AS passes, goal % source_size AS rest, (source_size + 255) // 256 AS blocks
  FROM (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS goal FROM t WHERE source_size > 0)),
c AS (SELECT *, passes * blocks + (rest + 255) // 256 AS slots FROM b),
f AS (SELECT *, CAST(sum(slots) OVER (ORDER BY no) - slots AS BIGINT) AS before, CAST(sum(slots) OVER () AS BIGINT) AS total FROM c),
e AS (SELECT *, CASE WHEN total < 2 THEN 0 ELSE length(ltrim(to_binary(total - 1), '0')) END AS bits FROM f),
v AS (SELECT *, before + unnest(range(slots)) AS point FROM e),
a AS (
  SELECT *, CAST(coalesce(list_sum(list_transform(range(bits), lambda i: ((point >> i) & 1) << (bits - 1 - i))), 0) AS BIGINT) AS "at" FROM v),
k AS (SELECT *, row_number() OVER (PARTITION BY no ORDER BY "at") - 1 AS place FROM a),
q AS (
  SELECT no, "at", place % blocks AS block, CASE WHEN place = slots - 1 AND rest > 0 THEN rest - place % blocks * 256 ELSE 256 END AS words FROM k),
x AS (SELECT r, no, start, size, unnest(range(start // 256, (start + size - 1) // 256 + 1)) AS block FROM l WHERE size > 0),
y AS (
  SELECT x.r, min(q."at") AS first_slot FROM x JOIN q ON x.no = q.no AND x.block = q.block
  WHERE x.start < q.block * 256 + q.words AND x.start + x.size > q.block * 256 GROUP BY x.r)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE goal // source_size * size
            + greatest(0, least(start + size, goal % source_size) - start) END AS BIGINT) AS taken, first_slot
FROM l LEFT JOIN y USING (r)
"""

LINE_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
         generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM d),
g AS (
  SELECT r, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS gram
  FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, gram) AS n FROM g WHERE gram IS NOT NULL) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY r),
l AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (
  SELECT r, source, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lw GROUP BY r),
hosts AS (SELECT source, count(*) AS docs FROM d GROUP BY source),
common AS (
  SELECT c.source, c.norm FROM (SELECT source, norm, count(DISTINCT r) AS docs, max(words) AS words FROM lw GROUP BY source, norm) c
  JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source WHERE (c.docs > 20 AND c.docs > h.docs * 0.05) OR (c.docs > 200 AND c.words >= 3)),
lost AS (
  SELECT r, sum(words) AS n FROM lw JOIN common c ON lw.norm = c.norm AND lw.source IS NOT DISTINCT FROM c.source GROUP BY r),
m AS (
  SELECT d.doc_id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS n_line_words
  FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_line_words AS BIGINT) AS n_line_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_line_words >= n_words * 0.3 AS kept
FROM m
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEAKS = rf"""
WITH words AS (
  SELECT 'd' AS side, CAST(row_number() OVER () AS BIGINT) AS r, doc_id AS id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
  UNION ALL
  SELECT 'i', CAST(row_number() OVER () AS BIGINT), item_id,
         regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+')
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
sizes AS (SELECT DISTINCT least(len(w), 5) AS width FROM words WHERE side = 'i' AND len(w) > 0),
s AS (
  SELECT DISTINCT side, r, id, width, array_to_string(w[k:k + width - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS k FROM words JOIN sizes ON CASE WHEN side = 'i' THEN width = least(len(w), 5) ELSE len(w) >= width END)),
n AS (SELECT r, count(*) AS n FROM s WHERE side = 'i' GROUP BY r),
m AS (
  SELECT d.r AS dr, d.id AS doc_id, i.r AS ir, i.id AS item_id, count(*) AS shared
  FROM s d JOIN s i ON d.gram = i.gram AND d.width = i.width WHERE d.side = 'd' AND i.side = 'i' GROUP BY ALL)
SELECT doc_id, item_id, CAST(shared AS INTEGER) AS shared, CAST(n AS INTEGER) AS shingles, shared / n AS containment
FROM m JOIN n ON m.ir = n.r WHERE shared >= ceil(round(0.8 * n, 9))
"""


def licences(templates: dict[str, str]) -> str:
    """The statement of the licence scan; templates are written out as values."""
    values = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in templates.items())
    fold = rf"""string_split(trim(regexp_replace(translate(%s, '{UPPER}', '{LOWER}'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ')"""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT r, doc_id, 'line' AS unit, x, generate_subscripts(x, 1) - 1 AS unit_no, unnest(x) AS body
  FROM (SELECT *, string_split(text, chr(10)) AS x FROM d)),
paragraphs AS (
  SELECT r, doc_id, 'paragraph' AS unit, x, generate_subscripts(x, 1) - 1 AS unit_no, unnest(x) AS body
  FROM (SELECT *, regexp_split_to_array(text, '\n[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n') AS x FROM d)),
units AS (
  SELECT r, doc_id, unit, unit_no, {fold % "body"} AS w FROM lines
  UNION ALL
  SELECT r, doc_id, unit, unit_no, {fold % "body"} FROM paragraphs
  WHERE contains(regexp_replace(body, '^[ \t\n\r\x0B\x0C]+|[ \t\n\r\x0B\x0C]+$', '', 'g'), chr(10))),
known AS (SELECT name, {fold % "body"} AS w FROM (VALUES {values}) v(name, body)),
u AS (SELECT DISTINCT r, doc_id, unit, unit_no, w[k] || ' ' || w[k + 1] AS pair
      FROM (SELECT *, unnest(range(1, len(w))) AS k FROM units WHERE len(w) > 1)),
t AS (SELECT DISTINCT name, w[k] || ' ' || w[k + 1] AS pair FROM (SELECT *, unnest(range(1, len(w))) AS k FROM known)),
un AS (SELECT r, unit, unit_no, count(*) AS n FROM u GROUP BY ALL),
tn AS (SELECT name, count(*) AS n FROM t GROUP BY ALL),
m AS (SELECT r, doc_id, unit, unit_no, name, count(*) AS n FROM u JOIN t USING (pair) GROUP BY ALL),
-- windows of as many words as a template has, in texts that share enough of its bigrams
tx AS (SELECT r, doc_id, {fold % "text"} AS w FROM d),
g AS (SELECT r, i, w[i + 1] || ' ' || w[i + 2] AS pair FROM (SELECT r, w, unnest(range(len(w) - 1)) AS i FROM tx WHERE len(w) > 1)),
c AS (
  SELECT r, name FROM (SELECT DISTINCT r, pair FROM g) JOIN t USING (pair) JOIN tn USING (name)
  GROUP BY r, name, tn.n HAVING count(*) >= tn.n * 0.8 / 1.2 - 1e-9),
st AS (
  SELECT c.r, tx.doc_id, c.name, len(tx.w) AS words, len(known.w) AS width, unnest(range(greatest(0, len(tx.w) - len(known.w)) + 1)) AS start
  FROM c JOIN tx USING (r) JOIN known USING (name)),
wp AS (SELECT r, doc_id, name, start, unnest(range(start, least(start + width, words) - 1)) AS i FROM st),
wd AS (
  SELECT wp.r, wp.doc_id, wp.name, wp.start, 2 * count(DISTINCT t.pair) / (count(DISTINCT g.pair) + any_value(tn.n)) AS dice
  FROM wp JOIN g ON wp.r = g.r AND wp.i = g.i JOIN tn ON wp.name = tn.name LEFT JOIN t ON t.name = wp.name AND t.pair = g.pair GROUP BY ALL),
runs AS (SELECT *, start - row_number() OVER (PARTITION BY r, name ORDER BY start) AS run FROM wd WHERE dice >= 0.8)
SELECT doc_id, 'window' AS unit, CAST(arg_max(start, (dice, -start)) AS INTEGER) AS unit_no, name AS licence, max(dice) AS dice
FROM runs GROUP BY r, doc_id, name, run
UNION ALL
SELECT m.doc_id, m.unit, CAST(m.unit_no AS INTEGER) AS unit_no, m.name AS licence, 2 * m.n / (un.n + tn.n) AS dice
FROM m JOIN un ON m.r = un.r AND m.unit = un.unit AND m.unit_no = un.unit_no JOIN tn ON m.name = tn.name
WHERE 2 * m.n / (un.n + tn.n) >= 0.8
"""


# crc32 in SQL: the table of the 256 remainders from its rule, then one step per byte of `x`.
CRC_TABLE = """tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))))"""


def crc(x: str) -> str:
    """crc32 of a text column; `tab` is among the tables read."""
    body = f"list_transform(range(0, octet_length(encode({x}))), lambda k: ('0x' || substr(hex({x}), 2 * k + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {body}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


RESAMPLING = rf"""
WITH {CRC_TABLE},
rows AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
grams AS (
  SELECT side, r, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM rows),
held AS (SELECT side, r, w, count(*) AS n FROM grams GROUP BY ALL),
known AS (SELECT w, {crc("w")} % 10000 AS bucket FROM (SELECT DISTINCT w FROM held), tab),
counts AS (
  SELECT bucket, CAST(coalesce(sum(n) FILTER (side = 'd'), 0) AS BIGINT) AS s, CAST(coalesce(sum(n) FILTER (side = 't'), 0) AS BIGINT) AS t
  FROM held JOIN known USING (w) GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE)
                                      / (CAST(s + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM counts, sums),
weights AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight
  FROM held JOIN known USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT
                                                        + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM rows LEFT JOIN weights USING (r) WHERE side = 'd'),
placed AS (
  SELECT *, n_features >= 20 AS able, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= n * 10 // 100 THEN place END AS rank FROM placed
"""


def _tree(name: str, source: str, levels: int, width: int = 8) -> list[str]:
    """Tables `name`0 .. : the nodes of every level (tree, i, h, n) from the leaves in `source`; and `name`r0 .. : the runs of siblings."""
    out = [f"{name}0 AS (SELECT tree, i, h, n FROM {source})"]
    for k in range(levels):
        out.append(f"{name}r{k} AS (SELECT tree, i // {width} AS i, n, list(h ORDER BY i) AS run FROM {name}{k} GROUP BY ALL)")
        out.append(f"""{name}{k + 1} AS (SELECT tree, i, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS h,
          CASE WHEN n > 1 THEN (n + {width - 1}) // {width} ELSE 1 END AS n FROM {name}r{k})""")
    return out


def _climb(name: str, first: str, tree: str, place: str, node: str, levels: int, width: int = 8) -> list[str]:
    """Tables `first`1 .. : rows of `first`0 with `others` and `node` one level further up."""
    out = []
    for k in range(levels):
        spot = f"({place} // {width**k} % {width})"
        out.append(f"""{first}{k + 1} AS (
          SELECT f.* REPLACE (
            CASE WHEN r.n > 1 THEN others || array_to_string(run[1:{spot}], '') || array_to_string(run[{spot} + 2:], '') ELSE others END AS others,
            CASE WHEN r.n > 1 THEN sha256(array_to_string(run[1:{spot}], '') || {node} || array_to_string(run[{spot} + 2:], '')) ELSE {node} END AS {node})
          FROM {first}{k} f JOIN {name}r{k} r ON r.tree IS NOT DISTINCT FROM f.{tree} AND r.i = {place} // {width**(k + 1)})""")
    return out


def manifest(levels: int = 7, group_levels: int = 3) -> str:
    """The statement of the Merkle manifest, written out for trees of up to 8 ** levels leaves and 8 ** group_levels groups."""

    def value(c: str) -> str:
        return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    doc_key = "coalesce(CAST(doc_id AS VARCHAR), '')"
    parts = [
        CRC_TABLE,
        f"docs AS (SELECT doc_id, lang AS tree, {leaf('text')} AS h, CASE WHEN {crc('key')} % 3 = 0 THEN {leaf(lowered)} END AS changed "
        f"FROM (SELECT *, {doc_key} AS key FROM documents), tab)",
        "leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM docs)",
        *_tree("a", "leaves", levels),
        f"subs AS (SELECT tree AS name, h, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, count(*) OVER () AS n, 0 AS tree FROM a{levels})",
        *_tree("b", "subs", group_levels),
        f"f0 AS (SELECT doc_id, tree, i, h AS leaf, coalesce(changed, h) AS node, '' AS others FROM leaves)",
        *_climb("a", "f", "tree", "f.i", "node", levels),
        f"g0 AS (SELECT f.*, s.h AS subroot, s.i AS at, 0 AS top FROM f{levels} f JOIN subs s ON s.name IS NOT DISTINCT FROM f.tree)",
        *_climb("b", "g", "top", "f.at", "node", group_levels),
    ]
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, b{group_levels}.h AS root, sha256(others) AS proof_sha256, node AS folded_root, node = b{group_levels}.h AS verified
FROM g{group_levels}, b{group_levels}"""
