"""SQL twins of the text operators that SQL can express."""

from tickloom.llm import decontam, quality, urlfilter

_SPACE = "[\\x20\\x09-\\x0D]+"


def _quality() -> str:
    classes = quality.CLASSES
    rests = [f"regexp_replace(text, '{_SPACE}', '', 'g')"]
    for c in classes:
        rests.append(f"regexp_replace({rests[-1]}, '{c}', '', 'g')")
    sizes = [f"length({r})" for r in rests]
    counts = [f"{a} - {b}" for a, b in zip(sizes, sizes[1:])] + [sizes[-1]]
    n = len(counts)
    columns = ", ".join(f"{c} AS k{i}" for i, c in enumerate(counts))
    sums = ", ".join(f"sum(k{i}) AS k{i}" for i in range(n))
    term = "(CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END)"
    # The distance of class shares: one term each way per class.
    shares = [(f"(d.k{i}::DOUBLE / d.word_chars)", f"(r.k{i}::DOUBLE / r.chars)") for i in range(n)]
    class_sum = " + ".join(term.format(a=p, b=q) + " + " + term.format(a=q, b=p) for p, q in shares)
    symbols = "".join(quality.SYMBOLS)
    return f"""
WITH base AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT row_id, unnest(list_filter(regexp_split_to_array(text, '{_SPACE}'), lambda x: x <> '')) AS word,
    generate_subscripts(list_filter(regexp_split_to_array(text, '{_SPACE}'), lambda x: x <> ''), 1) AS pos FROM base
), n AS (SELECT row_id, count(*) AS n_words FROM w GROUP BY row_id
), t AS (
  SELECT row_id, pos, word || ' ' || lead(word, 1) OVER d || ' ' || lead(word, 2) OVER d AS triple
  FROM w WINDOW d AS (PARTITION BY row_id ORDER BY pos)
), again AS (
  SELECT row_id, pos FROM (SELECT row_id, pos, count(*) OVER (PARTITION BY row_id, triple) AS c FROM t WHERE triple IS NOT NULL) x
  WHERE c > 1
), rep AS (
  SELECT row_id, count(DISTINCT pos + step) AS n_repeat_words FROM again, (SELECT unnest([0, 1, 2]) AS step) steps GROUP BY row_id
), lines AS (
  SELECT row_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM base) x
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY row_id
), d AS (
  SELECT b.row_id, b.doc_id, b.lang, coalesce(n.n_words, 0) AS n_words, {sizes[0]} AS word_chars,
    length(text) - length(translate(text, '{symbols}', '')) AS n_symbols,
    coalesce(lines.n_dup_lines, 0) AS n_dup_lines, coalesce(rep.n_repeat_words, 0) AS n_repeat_words, {columns}
  FROM base b LEFT JOIN n USING (row_id) LEFT JOIN rep USING (row_id) LEFT JOIN lines USING (row_id)
), sums AS (
  SELECT lang, count(*) AS documents, sum(n_words) AS all_words, {sums} FROM d WHERE n_words >= {quality.MIN_WORDS} GROUP BY lang
), named AS (
  SELECT * FROM sums WHERE lang IS NOT NULL
), wide AS (
  SELECT lang, all_words, {", ".join(f"k{i}" for i in range(n))} FROM named
  UNION ALL SELECT NULL, sum(all_words), {sums} FROM sums
), r AS (SELECT *, {" + ".join(f"k{i}" for i in range(n))} AS chars FROM wide
), wc AS (
  SELECT d.lang, w.word, count(*) AS c FROM w JOIN d USING (row_id)
  WHERE d.n_words >= {quality.MIN_WORDS} AND length(w.word) <= {quality.COMMON_CHARS} GROUP BY d.lang, w.word
), both_counts AS (
  SELECT * FROM wc WHERE lang IS NOT NULL UNION ALL SELECT NULL AS lang, word, sum(c) AS c FROM wc GROUP BY word
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY c DESC, word) AS rank FROM both_counts) x
  WHERE rank <= {quality.COMMON_WORDS}
), ref AS (SELECT row_id, CASE WHEN lang IN (SELECT lang FROM named) THEN lang END AS ref FROM d
), hits AS (SELECT row_id, word, count(*) AS c FROM w GROUP BY row_id, word
), pairs AS (
  SELECT ref.row_id, d.n_words, b.rank, b.c::DOUBLE / r.all_words AS q, coalesce(h.c, 0)::DOUBLE / d.n_words AS p
  FROM ref JOIN d USING (row_id) JOIN best b ON b.lang IS NOT DISTINCT FROM ref.ref
  JOIN r ON r.lang IS NOT DISTINCT FROM ref.ref
  LEFT JOIN hits h ON h.row_id = ref.row_id AND h.word = b.word WHERE d.n_words >= {quality.WORD_GUARD}
), bins AS (
  SELECT row_id, p, q FROM pairs UNION ALL
  SELECT row_id, 1 - sum(p), 1 - sum(q) FROM pairs GROUP BY row_id
), word_distance AS (
  SELECT row_id, sqrt(greatest(sum({term.format(a="p", b="q")} + {term.format(a="q", b="p")}) / 2, 0)) AS x FROM bins GROUP BY row_id
), class_distance AS (
  SELECT d.row_id, sqrt(greatest(({class_sum}) / 2, 0)) AS x
  FROM d JOIN ref USING (row_id) JOIN r ON r.lang IS NOT DISTINCT FROM ref.ref WHERE d.word_chars >= {quality.CLASS_GUARD}
), judged AS (
  SELECT d.*, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
    coalesce(cd.x, 0) <= {quality.CLASS_LIMIT} AND coalesce(wd.x, 0) <= {quality.WORD_LIMIT} AS near
  FROM d LEFT JOIN class_distance cd USING (row_id) LEFT JOIN word_distance wd USING (row_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND near AS kept FROM judged"""


_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT item_id, least(len(w), {decontam.WINDOW}) AS n,
    unnest(list_transform(range(1, greatest(len(w) - {decontam.WINDOW} + 1, 1) + 1),
      lambda x: array_to_string(list_slice(w, x, x + least(len(w), {decontam.WINDOW}) - 1), ' '))) AS win
  FROM i WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT row_id, n, unnest(range(1, len(w) - n + 2)) AS pos,
    unnest(list_transform(range(1, len(w) - n + 2), lambda x: array_to_string(list_slice(w, x, x + n - 1), ' '))) AS win
  FROM d, sizes WHERE len(w) >= n
),
m AS (SELECT DISTINCT dw.row_id, dw.pos, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
hit AS (SELECT row_id, count(DISTINCT pos + step) AS n_hit FROM (SELECT row_id, pos, unnest(range(0, n)) AS step FROM m) x GROUP BY row_id),
found AS (
  SELECT row_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS name FROM m) x GROUP BY row_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row_id) LEFT JOIN found USING (row_id)"""

ARCHIVE = """
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (SELECT digest, min(page_id) AS first_id, count(*) AS n FROM p WHERE size >= 100 GROUP BY digest),
j AS (
  SELECT p.*, CASE WHEN f.n > 1 AND (p.page_id IS NULL OR p.page_id <> f.first_id) THEN f.first_id END AS refers_to
  FROM p LEFT JOIN f ON f.digest = p.digest
)
SELECT page_id, url, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM j"""

# CRC-32 of a number's decimal digits, bit by bit.
_BITS = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
_CODES = "list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))"
_CRC = f"xor(list_reduce(list_prepend(4294967295, {_CODES}), lambda a, b: {_BITS}), 4294967295)"

CONVERSATIONS = f"""
WITH t AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS n,
    sha256(concat_ws(':', length(coalesce(role, '')), coalesce(role, ''), coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos FROM t
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base_id, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t) x
), whole AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.k, o.n FROM c JOIN own o ON o.conv_id = c.base_id AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, o.pos, o.k, o.n FROM c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
), path AS (
  SELECT conv_id, 0 AS depth, '' AS node, 0 AS n FROM c UNION ALL
  SELECT conv_id, row_number() OVER w AS depth, array_to_string(list(k) OVER w, ',') AS node, n FROM whole
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), nodes AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, min(n) AS n FROM path GROUP BY depth, node
), up AS (
  SELECT y.depth, y.node, p.node AS parent FROM nodes y JOIN path p ON p.conv_id = y.conv_id AND p.depth = y.depth - 1
), kids AS (SELECT parent AS node, count(*) AS n_children FROM up GROUP BY parent
), below AS (
  SELECT a.node, sum((y.n_convs - 1) * y.n) AS saved, sum(CASE WHEN k.node IS NULL THEN 1 ELSE 0 END) AS n_leaves
  FROM nodes y LEFT JOIN kids k ON k.node = y.node JOIN path a ON a.conv_id = y.conv_id AND a.depth <= y.depth GROUP BY a.node
), ends AS (
  SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS names FROM (
    SELECT conv_id, node, row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) AS last FROM path) x
  WHERE last = 1 GROUP BY node
)
SELECT y.conv_id, CAST(y.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, y.n_convs,
  CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.names, '')) AS ends_sha256
FROM nodes y JOIN below b USING (node) LEFT JOIN up u USING (node) LEFT JOIN nodes q ON q.node = u.parent
LEFT JOIN kids k ON k.node = y.node LEFT JOIN ends e ON e.node = y.node"""


def _urls() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = f"translate(host || path, '{upper}', '{upper.lower()}')"
    plain = f"regexp_replace({lower}, '[^a-z0-9./?=&_%-]', chr(127), 'g')"
    symbols = f"translate({plain}, '{urlfilter._PUNCTUATION}', '{urlfilter._STANDS_FOR}')"
    rules = urlfilter.ordered(urlfilter.RULES)
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in rules]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in zip(fits, rules)) + " END"
    ruled = "CASE " + " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, rules)) + " END"
    bits = urlfilter.BITS
    code = " + ".join(
        ["sym"] + [f"coalesce(lag(sym, {k}) OVER w, 0) * {1 << bits * k}" for k in range(1, urlfilter.ORDER + 1)]
    )
    levels = []
    for k in range(urlfilter.ORDER + 1):
        low = {c: f"s.p{c}" if k else str(1 / urlfilter.SYMBOLS) for c in "ar"}
        mixed = ", ".join(
            f"CASE WHEN sum(t.{c}) OVER w > 0 THEN (t.{c} + count_if(t.{c} > 0) OVER w * {low[c]}) / "
            f"(sum(t.{c}) OVER w + count_if(t.{c} > 0) OVER w) ELSE {low[c]} END AS p{c}"
            for c in "ar"
        )
        shorter = f"JOIN level{k - 1} s ON s.code = t.code & {(1 << bits * k) - 1}" if k else ""
        levels.append(f"""level{k} AS (
  SELECT t.code, {mixed} FROM (
    SELECT code & {(1 << bits * (k + 1)) - 1} AS code, sum(a) AS a, sum(r) AS r FROM occurring GROUP BY ALL) t {shorter}
  WINDOW w AS (PARTITION BY t.code >> {bits})
)""")
    return f"""
WITH parts AS (
  SELECT row_number() OVER () AS row_id, page_id, substr(sha256(coalesce(url, '')), 1, 1) < '{urlfilter.CALIBRATION}' AS held,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{upper}', '{upper.lower()}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), d AS (SELECT *, {rule} AS rule, {ruled} AS ruled FROM parts
), chars AS (
  SELECT row_id, held, ruled, ascii(unnest(string_split({symbols}, ''))) & {urlfilter.SYMBOLS - 1} AS sym,
    generate_subscripts(string_split({symbols}, ''), 1) AS pos FROM d WHERE host || path <> ''
), codes AS (
  SELECT row_id, held, ruled, {code} AS code FROM chars WINDOW w AS (PARTITION BY row_id ORDER BY pos)
), occurring AS (
  SELECT code, sum(CASE WHEN NOT held AND ruled = 'allow' THEN 1 ELSE 0 END) AS a,
    sum(CASE WHEN NOT held AND ruled = 'block' THEN 1 ELSE 0 END) AS r FROM codes GROUP BY code
), {", ".join(levels)},
scored AS (
  SELECT c.row_id, any_value(c.held) AS held, any_value(c.ruled) AS ruled, sum(ln(l.pa / l.pr)) / count(*) AS score
  FROM codes c JOIN level{urlfilter.ORDER} l USING (code) GROUP BY c.row_id
), spread AS (
  SELECT avg(score) FILTER (ruled = 'allow') AS ma, stddev_pop(score) FILTER (ruled = 'allow') AS sa,
    avg(score) FILTER (ruled = 'block') AS mr, stddev_pop(score) FILTER (ruled = 'block') AS sr FROM scored WHERE held
), bound AS (SELECT CASE WHEN sa + sr > 0 THEN (ma * sr + mr * sa) / (sa + sr) ELSE (ma + mr) / 2 END AS bound FROM spread)
SELECT d.page_id, d.host, d.path, d.rule,
  coalesce(d.ruled, CASE WHEN s.score < (SELECT bound FROM bound) THEN 'block' ELSE 'allow' END) AS verdict
FROM d LEFT JOIN scored s USING (row_id)"""


ORACLE_SQL = {"op1_quality": _quality(), "op8_decontamination": DECONTAMINATION, "op9_warc": ARCHIVE, "op11_conversations": CONVERSATIONS, "op13_urls": _urls()}
