"""DuckDB SQL with the same results as the corpus queries, where SQL can express them."""

from __future__ import annotations

from .hostrules import CLEARED, DOUBTFUL, MAX_DUP_LINES, MAX_RATE, MAX_REPEATED, MAX_SYMBOLS, MIN_WORDS
from .mixing import EPOCHS, SEED, SHARE, WEIGHTS
from .sharding import SEED as SHARD_SEED
from .sharding import SHARDS
from .suffixes import SPAN
from .warc import BREAKS, DATE, ENTITIES, HIDDEN, LANGUAGE, LINK, TAG, TITLE

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len({WORDS}), 0) AS BIGINT) AS size FROM documents
), by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS source_no
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, [{", ".join(f"{float(w)}::DOUBLE" for w in WEIGHTS)}][CAST((source_no - 1) % {len(WEIGHTS)} + 1 AS INT)] AS weight,
         source_size * {float(EPOCHS)}::DOUBLE AS cap,
         sum(source_size) OVER () * {float(SHARE)}::DOUBLE AS everything
  FROM by_source
), leveled AS (
  SELECT *, (everything - coalesce(sum(cap) OVER (ORDER BY cap / weight, source_no
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY cap / weight, source_no
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), targets AS (
  SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM leveled
), streamed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source
           ORDER BY md5('{SEED}:' || coalesce(CAST(s.doc_id AS VARCHAR), '')), s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(
  {" + ".join(f"greatest(0, least({e} * source_size + start + size, floor(target)) - ({e} * source_size + start))" for e in range(EPOCHS))}
  AS BIGINT) AS taken
FROM streamed
"""

SHARDING = f"""
WITH ranked AS (
  SELECT doc_id, source, text, md5('{SHARD_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         row_number() OVER (PARTITION BY source
           ORDER BY md5('{SHARD_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), ''))) - 1 AS rank,
         count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * rank + 1) / (2 * n), source NULLS LAST, key) - 1 AS place FROM ranked
), cut AS (
  SELECT *, place * {SHARDS} // total AS shard FROM placed
), polynomial AS (
  -- the 256 entries of the table of CRC-32, from its polynomial
  SELECT list(c ORDER BY b) AS entries FROM (
    SELECT b, list_reduce([b] || range(8), lambda c, k: CASE WHEN c & 1 = 1
      THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) t(b))
), sums AS (
  SELECT doc_id, source, text, shard, place, total, xor(list_reduce(
    [CAST(4294967295 AS BIGINT)] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda h: CAST('0x' || h AS BIGINT)),
    lambda crc, b: xor(crc >> 8, entries[xor(crc & 255, b) + 1])), 4294967295) AS crc
  FROM cut, polynomial
)
SELECT doc_id, CAST(coalesce(strlen(text), 0) + 8 AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32,
       'rows' AS law, CAST(shard AS INT) AS shard,
       CAST(place - (shard * total + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
FROM sums
"""

_FAILS = {
    "short": f"n_words < {MIN_WORDS}",
    "repeating": f"100 * n_repeat_words > {MAX_REPEATED} * n_words",
    "symbols": f"100 * n_symbols > {MAX_SYMBOLS} * n_words",
    "lines": f"n_dup_lines > {MAX_DUP_LINES}",
}
HOST_RULES = rf"""
WITH tokens AS (
  SELECT doc_id, source, coalesce(text, '') AS text, coalesce({WORDS}, []) AS words FROM documents
), starts AS (
  SELECT doc_id, unnest(range(len(words) - 2)) AS i, words FROM tokens WHERE len(words) > 2
), windows AS (
  SELECT doc_id, i, words[CAST(i + 1 AS INT)] || ' ' || words[CAST(i + 2 AS INT)] || ' ' || words[CAST(i + 3 AS INT)] AS w FROM starts
), found_again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, CAST(count(DISTINCT i + k) AS BIGINT) AS n FROM found_again, range(3) s(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS n FROM (
    SELECT doc_id, line, count(*) AS n
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM tokens)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line) GROUP BY doc_id
), stats AS (
  SELECT t.doc_id, t.source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM tokens t LEFT JOIN covered c USING (doc_id) LEFT JOIN lines l USING (doc_id)
), hosts AS (
  SELECT source, count(*) AS n, {", ".join(f"sum(CAST({c} AS INT)) AS f_{r}" for r, c in _FAILS.items())} FROM stats GROUP BY source
), moments AS (
  SELECT {", ".join(f"avg(f_{r} / n) AS m_{r}, var_pop(f_{r} / n) AS v_{r}" for r in _FAILS)} FROM hosts
), prior AS (
  SELECT *, {", ".join(f"CASE WHEN v_{r} > 0 THEN least(greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, 1), 1000) ELSE 1000 END AS w_{r}" for r in _FAILS)} FROM moments
), verdicts AS (
  SELECT source, greatest({", ".join(f"(f_{r} + m_{r} * w_{r}) / (n + w_{r})" for r in _FAILS)}) > {MAX_RATE} AS bad,
         {", ".join(f"(f_{r} + m_{r} * w_{r}) / (n + w_{r}) < m_{r} - {CLEARED} * sqrt(m_{r} * (1 - m_{r}) / (w_{r} + 1)) AS free_{r}" for r in DOUBTFUL)}
  FROM hosts, prior
), judged AS (
  SELECT s.*, bad OR {" OR ".join(f"({_FAILS[r]} AND NOT free_{r})" for r in DOUBTFUL)} AS bad, {_FAILS["short"]} OR {_FAILS["repeating"]} AS base_failed
  FROM stats s JOIN verdicts v ON s.source IS NOT DISTINCT FROM v.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT bad AS kept
FROM judged
"""

SUFFIXES = f"""
WITH bytes AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), windows AS (
  SELECT doc_id, p, substr(h, CAST(2 * p + 1 AS INT), {2 * SPAN}) AS w
  FROM (SELECT doc_id, h, unnest(range(greatest(len(h) // 2 - {SPAN - 1}, 0))) AS p FROM bytes)
), owned AS (
  SELECT doc_id, p, min(doc_id) OVER (PARTITION BY w) AS owner FROM windows
), gone AS (
  SELECT doc_id, p, max(p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM owned WHERE owner < doc_id
), spans AS (
  SELECT doc_id, min(p) AS a, max(p) + {SPAN} AS b FROM (
    SELECT doc_id, p, sum(CASE WHEN before IS NULL OR before + {SPAN} < p THEN 1 ELSE 0 END)
      OVER (PARTITION BY doc_id ORDER BY p) AS k FROM gone) GROUP BY doc_id, k
), gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_byte FROM spans
), pieces AS (
  SELECT doc_id, from_byte, a AS to_byte FROM gaps
  UNION ALL
  SELECT b.doc_id, coalesce(s.b, 0), len(h) // 2
  FROM bytes b LEFT JOIN (SELECT doc_id, max(b) AS b FROM spans GROUP BY doc_id) s USING (doc_id)
), kept AS (
  SELECT doc_id, string_agg(substr(h, CAST(2 * from_byte + 1 AS INT), CAST(2 * (to_byte - from_byte) AS INT)), '' ORDER BY from_byte, to_byte) AS k
  FROM pieces JOIN bytes USING (doc_id) GROUP BY doc_id
), sums AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, CAST(count(*) AS BIGINT) AS n_spans FROM spans GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM bytes JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _warc() -> str:
    text = "html"
    for pattern in HIDDEN:
        text = f"regexp_replace({text}, {_quoted(pattern)}, ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, {_quoted(BREAKS)}, chr(10), 'g'), {_quoted(TAG)}, '', 'g')"
    for name, letter in ENTITIES:
        text = f"replace({text}, {_quoted(name)}, {_quoted(letter)})"
    text = f"regexp_replace({text}, '[ \\t\\r]+', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, ' ?\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"
    crlf = "chr(13) || chr(10)"

    def urn(seed: str) -> str:
        h = f"sha256({seed})"
        cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
        return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in cuts) + " || '>'"

    def line(name: str, value: str) -> str:
        return f"coalesce('{name}: ' || ({value}) || {crlf}, '')"

    title = rf"regexp_replace(regexp_extract(html, {_quoted(TITLE)}, 1), '\s+', ' ', 'g')"
    language = f"regexp_extract(html, {_quoted(LANGUAGE)}, 1)"
    return f"""
WITH pages_ AS (
  SELECT page_id, url, coalesce(html, '') AS html FROM pages
), blocks AS (
  SELECT *, 'HTTP/1.1 200 OK' || {crlf} || 'Content-Type: text/html; charset=utf-8' || {crlf} || 'Content-Length: '
         || strlen(html) || {crlf} || {crlf} || html AS response,
         {urn("'response:' || coalesce(CAST(page_id AS VARCHAR), '') || ':' || coalesce(url, '')")} AS source_id
  FROM pages_
), made AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
    {line("title", f"CASE WHEN {title} <> '' THEN {title} END")} || {line("language", f"CASE WHEN {language} <> '' THEN {language} END")}
    || {line("source-status", "'200'")} || {line("source-content-type", "'text/html; charset=utf-8'")}
    || {line("source-content-length", "strlen(html)")} || {line("source-block-digest", "'sha256:' || sha256(response)")}
    || coalesce(array_to_string(list_transform(regexp_extract_all(html, {_quoted(LINK)}, 1), lambda l: 'outlink: ' || l || {crlf}), ''), '') AS block
  FROM blocks
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', {text} FROM blocks
), named AS (
  SELECT *, {urn("'derived:' || record_type || ':' || source_id")} AS record_id, 'sha256:' || sha256(html) AS source_digest FROM made
)
SELECT page_id, record_type, record_id, source_id AS refers_to, url AS target_uri, source_digest,
       'sha256:' || sha256(block) AS block_digest, CAST(strlen(block) AS BIGINT) AS content_length,
       'WARC/1.1' || {crlf} || {line("WARC-Type", "record_type")} || {line("WARC-Record-ID", "record_id")}
       || {line("WARC-Refers-To", "source_id")} || {line("WARC-Target-URI", "url")} || {line("WARC-Date", _quoted(DATE))}
       || {line("WARC-Source-Payload-Digest", "source_digest")} || {line("WARC-Block-Digest", "'sha256:' || sha256(block)")}
       || {line("Content-Type", "content_type")} || {line("Content-Length", "strlen(block)")} AS header, block
FROM named
"""


WARC = _warc()

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEXICAL = rf"""
WITH term AS (
  SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL
), size AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM term GROUP BY doc_id
), corpus AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size
), having_term AS (
  SELECT term, count(*) AS df FROM term GROUP BY term
), wanted AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
), weighed AS (
  SELECT item_id, term, times * CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM wanted JOIN having_term USING (term), corpus
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM weighed JOIN term USING (term) JOIN size USING (doc_id), corpus GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""

DECONTAMINATION = rf"""
WITH item AS (
  SELECT item_id, {_TERMS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS width, array_to_string(w[CAST(i + 1 AS INT):CAST(i + least(len(w), 10) AS INT)], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT doc_id, {_TERMS} AS w FROM documents
), runs AS (
  SELECT doc_id, i, width, array_to_string(w[CAST(i + 1 AS INT):CAST(i + width AS INT)], ' ') AS words
  FROM (SELECT doc_id, w, width, unnest(range(greatest(len(w) - width + 1, 0))) AS i
        FROM doc, (SELECT DISTINCT width FROM windows))
), hits AS (
  SELECT doc_id, item_id, i, width FROM runs JOIN windows USING (width, words)
), hit_words AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, i + k FROM (SELECT doc_id, i, unnest(range(width)) AS k FROM hits) t(doc_id, i, k)) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
"""


def _conversations() -> str:
    """The cheapest edits step by step over the rows of a conversation. What is known of a state
    (0 nothing kept, 1 a system turn, 2 a user's last, 3 an assistant's last) is one string: the cost
    in nine digits and the audit, so the least string is the least (cost, audit)."""

    def more(key: str, cost: str, edit: str) -> str:
        return f"lpad(CAST(CAST(substr({key}, 1, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({key}, 10) || '{edit}'"

    grown = {"i0": "k0", "i1": "k1",
             "i2": f"least(k2, {more('k0', '3', 'I')}, {more('k1', '3', 'I')}, {more('k3', '3', 'I')})",
             "i3": f"least(k3, {more('k2', '3', 'I')}, {more('k0', '6', 'II')}, {more('k1', '6', 'II')})"}
    inserted = ", ".join(f"{v} AS {k}" for k, v in grown.items())

    def shift(edit: str, cost: str, to: int) -> list[str]:
        return [more(f"i{s}", cost, edit) for s in ((0, 1, 3) if to == 2 else (2,))]

    def step(to: int, system: bool = False) -> str:
        ways = [more(f"i{to}", "4", "D")]
        if system:
            ways.append(f"CASE WHEN may AND initial = 's' THEN {more('i0', 'cut', 'K')} END")
        elif to > 1:
            initial = "u" if to == 2 else "a"
            ways += [f"CASE WHEN may AND initial = '{initial}' THEN {w} END" for w in shift("K", "cut", to)]
            ways += [f"CASE WHEN may THEN {w} END" for w in shift("R", "3 + cut", to)]
        return f"least({', '.join(ways)})" if len(ways) > 1 else ways[0]

    return rf"""
WITH RECURSIVE polynomial AS (
  SELECT list(c ORDER BY b) AS entries FROM (
    SELECT b, list_reduce([b] || range(8), lambda c, k: CASE WHEN c & 1 = 1
      THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) t(b))
), summed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
    [CAST(4294967295 AS BIGINT)] || list_transform(regexp_extract_all(
      hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))), '..'),
      lambda h: CAST('0x' || h AS BIGINT)),
    lambda crc, b: xor(crc >> 8, entries[xor(crc & 255, b) + 1])), 4294967295) % 20 AS kind
  FROM conversations, polynomial
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM summed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged
), flagged AS (
  SELECT *, substr(role, 1, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
         coalesce(lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed
), steps AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS k0, CAST(NULL AS VARCHAR) AS k1,
         CAST(NULL AS VARCHAR) AS k2, CAST(NULL AS VARCHAR) AS k3 FROM conversations
  UNION ALL
  SELECT conv_id, i, {step(0)}, {step(1, system=True)}, {step(2)}, {step(3)}
  FROM (SELECT s.conv_id, f.i, fault NOT IN ('blank', 'duplicate') AS may, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cut,
               initial, {inserted}
        FROM steps s JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1)
), last AS (
  SELECT conv_id, least(k0, i3) AS k FROM (
    SELECT conv_id, k0, {grown["i3"]} AS i3 FROM steps QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)
), edits AS (
  SELECT conv_id, unnest(range(len(k) - 9)) AS p, substr(k, 10) AS audit FROM last
), walked AS (
  SELECT conv_id, p, substr(audit, CAST(p + 1 AS INT), 1) AS edit,
         len(regexp_replace(substr(audit, 1, CAST(p + 1 AS INT)), 'I', '', 'g')) AS i,
         len(regexp_replace(substr(audit, 1, CAST(p AS INT)), 'D', '', 'g')) AS before
  FROM edits
), kept AS (
  SELECT w.conv_id, p, edit, before, f.role, f.text,
         max(CASE WHEN edit = 'K' AND before = 0 AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY w.conv_id) AS lead
  FROM walked w LEFT JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i AND w.edit <> 'I'
  WHERE edit <> 'D'
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (before - lead) % 2 = 0 THEN 'user' ELSE 'assistant' END
                             || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS repaired FROM kept GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (illegal) AS illegal FROM flagged GROUP BY conv_id
)
SELECT l.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(substr(k, 1, 9) AS BIGINT) AS cost,
       substr(k, 10) AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM last l LEFT JOIN texts t ON l.conv_id IS NOT DISTINCT FROM t.conv_id
LEFT JOIN counts c ON l.conv_id IS NOT DISTINCT FROM c.conv_id
"""


CONVERSATIONS = _conversations()
