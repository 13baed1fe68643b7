"""Each query's equivalent in DuckDB SQL over the same tables."""

from __future__ import annotations

from threadloom.functions import predicates as P
from threadloom.functions.text import THOUGHT_CUES
from threadloom.operators.extraction import ENTITY_TYPES, RELATION_TYPES, TIMELINE_EVENTS
from threadloom.sources.views import MESSAGES_SQL, REUSE_SQL


def q(text: str) -> str:
    """An SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def rx(name: str, text: str = "text") -> str:
    return f"regexp_matches({text}, {q(P.PATTERNS[name])})"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sid(x: str) -> str:
    return f"'srcmsg_' || substr(sha256({x}), 1, 32)"


CANON = sid("source_file || chr(31) || conversation_id || chr(31) || message_id")
MSG = f"WITH messages AS (SELECT *, {CANON} AS canonical_id FROM ({MESSAGES_SQL}) m)"
CLEAN = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


def clean(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def words(x: str) -> str:
    return rf"regexp_extract_all(lower(regexp_replace({x}, '\*\*|__|##+|[-*]\s', ' ', 'g')), '[a-z0-9'']+')"


def key(x: str) -> str:
    return f"array_to_string(regexp_extract_all(lower({x}), '[a-z0-9]+'), ' ')"


def summary(x: str) -> str:
    c = clean(x)
    sentence = rf"regexp_extract({c}, '^(.*?[.!?])\s', 1)"
    return f"trim(substr(CASE WHEN {sentence} <> '' THEN {sentence} ELSE {c} END, 1, 160))"


def title(x: str) -> str:
    t = rf"regexp_replace(regexp_replace({summary(x)}, '^[# \-]+', ''), '[# \-]+$', '')"
    return f"substr(CASE WHEN {t} <> '' THEN {t} ELSE 'Untitled Extracted Knowledge' END, 1, 80)"


def thought_type(x: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({x}), {q(c)}) THEN {q(v)}" for c, v in THOUGHT_CUES) + " ELSE 'observation' END"


def role_class(x: str = "role") -> str:
    return f"CASE {x} WHEN 'user' THEN 'D0' WHEN 'assistant' THEN 'A0' ELSE 'X0' END"


def shingles(w: str, k: int) -> str:
    return f"list_transform(range(0, greatest(len({w}) - {k} + 1, 0)), lambda i: array_to_string(list_slice({w}, i + 1, i + {k}), ' '))"


def numbered(prefix: str, seed: str) -> str:
    return f"'{prefix}' || lpad(CAST(CAST(('0x' || substr(sha256({seed}), 1, 12)) AS BIGINT) % 10000000 AS VARCHAR), 7, '0')"


SEED = f"'thought' || chr(31) || canonical_id || chr(31) || {strip('text')}"
THOUGHTS = f"""{MSG}, thoughts AS (
SELECT 'TH' || substr(sha256({SEED}), 1, 24) AS thought_id, {numbered('T', SEED)} AS display_id, {title('text')} AS name, {thought_type('text')} AS type,
       CASE role WHEN 'user' THEN 'principal' WHEN 'assistant' THEN 'assistant' ELSE 'unknown' END AS originator, {role_class()} AS evidence_class,
       CAST(CASE role WHEN 'user' THEN 1.0 WHEN 'assistant' THEN 0.7 ELSE 0.2 END AS DOUBLE) AS confidence, coalesce(ts, '1970-01-01T00:00:00+00:00') AS created_at, {summary('text')} AS summary, {strip('text')} AS detail,
       canonical_id, message_id, conversation_id, source_file, role, ts
FROM messages WHERE {strip('text')} <> '')"""

_KINDS = "|".join(ENTITY_TYPES)
_TYPED = rf"(?i)^\s*([^()|]+?)\s*(?:\(({_KINDS})\)|\|\s*({_KINDS}))?\s*$"
_ORD = "row(source_file, conversation_id, coalesce(ts, ''), canonical_id, pos)"
ENTITIES = f"""{THOUGHTS}, lines AS (SELECT source_file, conversation_id, ts, canonical_id, role, unnest(regexp_extract_all(text, {q(P.ENTITY_LINE)})) AS line, generate_subscripts(regexp_extract_all(text, {q(P.ENTITY_LINE)}), 1) - 1 AS pos FROM messages),
raws AS (SELECT *, trim(regexp_extract(line, {q(P.ENTITY_LINE)}, 2)) AS raw, lower(regexp_extract(line, {q(P.ENTITY_LINE)}, 1)) AS prefix FROM lines),
named AS (SELECT *, trim(regexp_extract(raw, {q(_TYPED)}, 1)) AS name, lower(coalesce(nullif(regexp_extract(raw, {q(_TYPED)}, 2), ''), nullif(regexp_extract(raw, {q(_TYPED)}, 3), ''), prefix)) AS type FROM raws),
mentions AS (SELECT *, {key('name')} AS norm, {_ORD} AS place FROM named WHERE name <> '' AND type IN ({", ".join(map(q, ENTITY_TYPES))}) AND {key('name')} <> ''),
entities AS (SELECT {numbered('E', 'type || chr(31) || norm')} AS entity_id, arg_min(name, place) AS name, norm, type, {role_class('arg_min(role, place)')} AS evidence_class, arg_min(conversation_id, place) AS first_conversation, arg_min(coalesce(ts, ''), place) AS first_ts,
  arg_max(conversation_id, place) AS last_conversation, arg_max(coalesce(ts, ''), place) AS last_ts, count(*) AS mention_count, list_sort(list_distinct(list(canonical_id))) AS provenance_refs FROM mentions GROUP BY norm, type)"""

_PASS = f"""WITH records AS ({REUSE_SQL}), w AS (SELECT canonical_id, source, role, ts, text, {words('text')} AS all_words FROM records WHERE length(text) >= 100),
cut AS (SELECT * EXCLUDE (all_words, text), unnest(CASE WHEN length(text) > 15000 AND len(all_words) > 0 THEN list_transform(range(0, len(all_words), 2250), lambda s: {{'idx': CAST(s / 2250 AS INTEGER), 'words': list_slice(all_words, s + 1, s + 2500)}}) ELSE [{{'idx': 0, 'words': all_words}}] END) AS p FROM w),
passages AS (SELECT canonical_id, source, role, ts, CAST(canonical_id AS VARCHAR) || '#p' || CAST(p.idx AS VARCHAR) AS passage_id, p.idx AS idx, p.words AS words FROM cut)"""
_PAIRS = f"""{_PASS}, places AS (SELECT passage_id, canonical_id, unnest({shingles('words', 12)}) AS sh, generate_subscripts({shingles('words', 12)}, 1) - 1 AS pos FROM passages),
ix AS (SELECT DISTINCT sh, passage_id, canonical_id FROM places),
pairs AS (SELECT a.passage_id AS reuse, a.canonical_id AS reuse_id, b.passage_id AS origin, b.canonical_id AS origin_id, count(*) AS shared FROM ix a JOIN ix b USING (sh) WHERE a.canonical_id <> b.canonical_id GROUP BY ALL HAVING count(*) >= 5)"""
_SPANS = f"""{_PAIRS}, points AS (SELECT reuse, origin, r.pos AS rp, o.pos - r.pos AS diag FROM pairs JOIN places r ON r.passage_id = reuse JOIN places o ON o.passage_id = origin AND o.sh = r.sh),
runs AS (SELECT reuse, origin, diag, rp - row_number() OVER (PARTITION BY reuse, origin, diag ORDER BY rp) AS run FROM points),
spans AS (SELECT reuse, origin, max(n) AS span FROM (SELECT reuse, origin, diag, run, count(*) AS n FROM runs GROUP BY ALL) GROUP BY ALL)"""
HITS = f"""{_SPANS}, sized AS (SELECT passage_id, len(list_distinct(s)) AS n_sh, len(s) AS n_raw, n_words FROM (SELECT passage_id, len(words) AS n_words, {shingles('words', 12)} AS s FROM passages)),
both_ AS (SELECT p.*, s.span, r.source AS rs, r.role AS rr, r.ts AS rts, o.source AS os, o.role AS orole, o.ts AS ots, a.n_sh AS reuse_shingles, b.n_sh AS origin_shingles, CASE WHEN r.ts IS NULL OR o.ts IS NULL THEN NULL ELSE o.ts < r.ts END AS valid
  FROM pairs p JOIN spans s USING (reuse, origin) JOIN records r ON r.canonical_id = reuse_id JOIN records o ON o.canonical_id = origin_id JOIN sized a ON a.passage_id = reuse JOIN sized b ON b.passage_id = origin),
ranked AS (SELECT *, row_number() OVER (PARTITION BY reuse ORDER BY coalesce(valid, false) DESC, span DESC, shared DESC, ots ASC NULLS LAST, origin_id, origin) AS nth, bool_or(coalesce(valid, false)) OVER (PARTITION BY reuse) AS any_valid, count(*) OVER (PARTITION BY reuse) AS n_origins FROM both_),
hits AS (SELECT reuse AS passage_id, reuse_id, origin_id, origin AS origin_passage, shared, span, span + 11 AS span_words, reuse_shingles, origin_shingles, n_origins, valid, NOT any_valid AS reverse_match, CASE WHEN any_valid THEN 'DERIVATION' ELSE 'SIMILARITY' END AS edge,
  rs <> os AS cross_source, rr <> orole AS cross_actor, shared * 100 >= reuse_shingles * 85 AND shared * 2 >= origin_shingles AS exact_copy FROM ranked WHERE nth = 1)"""
_EDGES = f"{HITS.replace('WITH ', 'WITH RECURSIVE ', 1)}, edges AS (SELECT DISTINCT origin_id AS u, reuse_id AS v FROM hits WHERE edge = 'DERIVATION' AND origin_id <> reuse_id)"
_ROOTS = f"{_EDGES}, sym AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges), walk(v, r) AS (SELECT u, u FROM sym UNION SELECT s.v, w.r FROM walk w JOIN sym s ON s.u = w.v), roots AS (SELECT v, min(r) AS root FROM walk GROUP BY v)"

STORE = """WITH store AS (SELECT concat('MBK-', CAST(doc_id % 50 AS STRING)) AS knowledge_id, CAST(row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id) AS INTEGER) AS revision,
  CASE WHEN row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id DESC) = 1 THEN CASE WHEN doc_id % 50 = 49 THEN 'RETIRED' ELSE 'CURRENT' END ELSE 'SUPERSEDED' END AS canonical_status,
  substr(text, 1, 40) AS title, substr(text, 1, 120) AS summary, text AS content, CASE WHEN doc_id % 3 = 0 THEN 'PENDING' ELSE 'ACCEPTED' END AS approval_status, CASE WHEN doc_id % 7 = 0 THEN 'HOLD' ELSE 'PUBLISH' END AS projection_policy,
  doc_id FROM documents)"""
