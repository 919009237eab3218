"""SQL that must give the rows of the queries, where SQL can express them."""

URL_VERDICTS = r"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
named AS (
  SELECT page_id, rest,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path,
    list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid|mc_cid|mc_eid)(=|$)'))) AS params
  FROM parts),
canon AS (
  SELECT page_id, host, path, CASE WHEN rest IS NOT NULL THEN
    regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS key
  FROM named),
listed AS (SELECT key FROM canon WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM canon)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

CHAT_FORMAT = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
-- A rendered turn is longer by its marks, by a backslash for each backslash and control string, and for each line end in the role.
sized AS (
  SELECT *, role || text AS both,
    length('<|im_start|>') + length('<|im_end|>') + 2 + length(role) + length(text)
    + length(role || text) - length(replace(role || text, chr(92), '')) + length(role) - length(replace(role, chr(10), ''))
    + len(regexp_extract_all(text, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|</?s>|\[/?INST\]'))
    + len(regexp_extract_all(role, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|</?s>|\[/?INST\]')) AS chars
  FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def crc32(text: str) -> str:
    """Unsigned crc32 of an expression's ASCII text, bit by bit."""
    bits = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda r, _: xor(r >> 1, 3988292384 * (r & 1)))"
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda t: CAST(ord(t) AS BIGINT))), "
            f"lambda c, b: {bits}), 4294967295)")


def _manifest(levels: int = 6) -> str:
    """Trees of up to 16 ** levels leaves, level by level; from where one node is left, the levels above change nothing."""
    part = "CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    joined = " || ".join(part.format(c=c) for c in ("doc_id", "source", "lang", "n_chars"))
    text = "CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || {} END"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [f"""WITH leaves AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS tree, sha256({joined} || {text.format('text')}) AS leaf,
    CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN sha256({joined} || {text.format(lowered)}) END AS tampered
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves)"""]

    def grown(name: str, first: str) -> None:
        out.append(f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM ({first}))")
        for k in range(levels):
            out.append(f"{name}run{k} AS (SELECT tree, pos // 16 AS run, any_value(n) AS n, list(d ORDER BY pos) AS ds FROM {name}{k} GROUP BY tree, pos // 16)")
            out.append(f"{name}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM "
                       f"(SELECT tree, run AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d FROM {name}run{k}))")

    def walked(name: str, source: str, runs: str, tree: str, at: str) -> str:
        last = source
        for k in range(levels):
            inside = f"(({at} // {16 ** k}) % 16)"
            left = f"CASE WHEN r.n > 1 THEN array_to_string(r.ds[1:{inside}], '') ELSE '' END"
            right = f"CASE WHEN r.n > 1 THEN array_to_string(r.ds[{inside} + 2:], '') ELSE '' END"
            out.append(f"{name}{k} AS (SELECT w.* EXCLUDE (proof, node), w.proof || {left} || {right} AS proof, "
                       f"CASE WHEN r.n > 1 THEN sha256({left} || w.node || {right}) ELSE w.node END AS node "
                       f"FROM {last} w JOIN {runs}run{k} r ON r.tree = {tree} AND r.run = {at} // {16 ** (k + 1)})")
            last = f"{name}{k}"
        return last

    grown("g", "SELECT tree, place AS pos, leaf AS d FROM placed")
    grown("s", f"SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, d FROM g{levels}")
    out.append(f"tops AS (SELECT tree AS of_tree, row_number() OVER (ORDER BY tree) - 1 AS top_at, d AS subroot FROM g{levels})")
    out.append("start AS (SELECT *, '' AS proof, coalesce(tampered, leaf) AS node FROM placed JOIN tops ON tree = of_tree)")
    inner = walked("a", "start", "g", "w.tree", "w.place")
    outer = walked("b", inner, "s", "''", "w.top_at")
    return ",\n".join(out) + f"""
SELECT doc_id, leaf, subroot, (SELECT d FROM s{levels}) AS root, sha256(proof) AS proof_sha256, node AS folded_root,
  node = (SELECT d FROM s{levels}) AS verified FROM {outer}"""


MANIFEST = _manifest()

_HEX = "strpos('0123456789ABCDEF', substr(bytes, {}, 1)) - 1"
_BITS = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda r, _: xor(r >> 1, 3988292384 * (r & 1)))"

SPELLING = rf"""
WITH said AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(list_transform(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'),
    lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS run FROM documents),
counted AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS bytes FROM said WHERE length(run) >= 7 GROUP BY id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(CAST(length(bytes) / 2 AS BIGINT)),
    lambda i: CAST(16 * ({_HEX.format('2 * i + 1')}) + {_HEX.format('2 * i + 2')} AS BIGINT))), lambda c, b: {_BITS}), 4294967295) AS h
  FROM counted),
cut AS (
  SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, unnest(range(length(word))) AS i FROM words),
less AS (SELECT DISTINCT word, substr(word, 1, i) || substr(word, i + 2) AS rest FROM places),
holes AS (SELECT word, i, substr(word, 1, i) || '?' || substr(word, i + 2) AS rest FROM places),
near AS (
  SELECT a.word, b.word AS near FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, w.word FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word FROM less l JOIN words w ON l.rest = w.word),
ranked AS (
  SELECT a.word, a.near, w.n AS near_n, count(*) OVER (PARTITION BY a.word) AS n_near,
    row_number() OVER (PARTITION BY a.word ORDER BY w.n DESC, encode(a.near)) AS place
  FROM near a JOIN words w ON a.near = w.word),
formed AS (
  SELECT w.word, w.n, CAST(coalesce(r.n_near, 0) AS BIGINT) AS n_near,
    CASE WHEN r.near_n >= 10 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 10 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1)
SELECT word, form, n, n_near, form_n, coalesce(f4, f3, f2, f1, form, word) AS root FROM (
  SELECT a.*, b.form AS f1, c.form AS f2, d.form AS f3, e.form AS f4 FROM formed a LEFT JOIN formed b ON a.form = b.word
  LEFT JOIN formed c ON b.form = c.word LEFT JOIN formed d ON c.form = d.word LEFT JOIN formed e ON d.form = e.word)
"""

REPEATS = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS i,
    unnest(list_transform(range(1, len(words) - 18), lambda k: sha256(array_to_string(words[k:k + 19], ' ')))) AS d
  FROM split WHERE len(words) >= 20),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY d ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM repeated),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split),
left_over AS (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS kept, count(*) AS n FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id)
SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words, CAST(len(s.words) - coalesce(l.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(l.kept, '')) AS kept_sha256
FROM split s LEFT JOIN left_over l ON s.doc_id = l.doc_id
"""
