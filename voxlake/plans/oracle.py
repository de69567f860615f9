"""The catalogue's queries as SQL for DuckDB, on views named like the tables."""

from __future__ import annotations

from voxlake.functions import text as T
from voxlake.plans.catalogue import AS_SCRIPT


def spans(stretch: float) -> str:
    return f"SELECT user_id, event_id, event_type, epoch_us(ts) / 1e6 AS s, epoch_us(ts) / 1e6 + value * {stretch} AS e FROM events"


#: First of the private-use characters that stand for something while a text is rewritten.
PRIVATE = 0xE000


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replaced(c: str, pairs) -> str:
    for a, b in pairs:
        c = f"replace({c}, {quoted(a)}, {quoted(b)})"
    return c


# RE2 knows \s as five ASCII characters: the class of Unicode white space is written out.
BLANK = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def words(c: str) -> str:
    return f"list_filter(string_split_regex({strip(c)}, '{BLANK}+'), lambda x: x <> '')"


def spoken(c: str) -> str:
    c = f"translate(replace(lower({c}), {quoted(T.JOINER)}, ''), {quoted(T.QUOTES)}, repeat(chr(39), {len(T.QUOTES)}))"
    return f"trim(regexp_replace(regexp_replace({c}, '[^a-z .,?!''\\-:;]', '', 'g'), ' +', ' ', 'g'))"


def fold_roman(c: str) -> str:
    c = f"translate(replace(lower({c}), {quoted(T.JOINER)}, ''), {quoted(T.QUOTES)}, repeat(chr(39), {len(T.QUOTES)}))"
    keys = sorted(T.ROMAN, key=len, reverse=True)
    marks = [chr(PRIVATE + i) for i in range(len(keys))]
    return spoken(replaced(replaced(c, zip(keys, marks, strict=True)), zip(marks, (T.ROMAN[k] for k in keys), strict=True)))


def fold_script(c: str) -> str:
    """Every consonant gets a mark that its sign or virama takes away again, and that is the vowel a where neither follows."""
    mark = chr(PRIVATE)
    c = f"regexp_replace(replace({c}, {quoted(T.JOINER)}, ''), '([{''.join(T.CONSONANTS)}])', '\\1{mark}', 'g')"
    gone = chr(PRIVATE + 1)
    c = replaced(c, [(mark + T.VIRAMA, gone)] + [(mark + s, t) for s, t in T.SIGNS.items()])
    c = f"regexp_replace({c}, '[{T.VIRAMA}{''.join(T.SIGNS)}{gone}]', '', 'g')"
    return spoken(replaced(c, [(mark, "a"), *T.CONSONANTS.items(), *T.VOWELS.items(), (T.ANUSVARA, "ng"), (T.VISARGA, "h")]))


KNOWN = "".join(dict.fromkeys(ch for k in T.ROMAN for ch in k if ord(ch) > 127)) + "‘’“”" + T.JOINER
FILE = r"regexp_replace(regexp_extract({p}, '([^/]*)/*$', 1), '(.)\.[^.]*$', '\1')"


def cascade(tests: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {t} THEN '{n}'" for n, t in tests) + " END"


MANIFEST = """SELECT d.doc_id, d.text, CASE WHEN d.doc_id % 97 = 0 THEN 'n/a' ELSE CAST(n_chars / 100.0 AS VARCHAR) END AS duration,
  CASE WHEN l.quality = 0 THEN 'False' WHEN l.quality = 1 THEN 'True' END AS snapped, CASE WHEN lang = 'es' THEN 'lofi' WHEN lang = 'en' THEN 'hifi' END AS quality
  FROM documents d LEFT JOIN labels l USING (doc_id)"""


def manifest_tests(quality: bool) -> str:
    t = strip("coalesce(text, '')")
    tests = [("quality!=hifi", "coalesce(quality, 'hifi') <> 'hifi'")] if quality else []
    return cascade([*tests, ("unsnapped", "coalesce(snapped, 'True') <> 'True'"), ("bad_duration", "TRY_CAST(duration AS DOUBLE) IS NULL"), ("longer_than_30s", "TRY_CAST(duration AS DOUBLE) > 30"), ("shorter_than_2s", "TRY_CAST(duration AS DOUBLE) < 2"), ("empty_text", f"{t} = ''"), ("text_over_2500_chars", f"length({t}) > 2500")])


SCRIPTED = "translate(text, 'ADEIOT', 'අදඑඉඔට')"
LINES = "SELECT CAST(doc_id AS VARCHAR) AS file, unnest(string_split(text, chr(10))) AS line, CAST(unnest(range(len(string_split(text, chr(10))))) AS BIGINT) AS line_no FROM documents"

LOG = """SELECT user_id AS log_id, event_id AS line_no, CASE event_type
  WHEN 'signup' THEN ' --> TIME: ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' -- STEP: ' || (event_id % 879) || '/879 -- GLOBAL_STEP: ' || event_id
  WHEN 'error' THEN ' > EVALUATION '
  WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN '   | > avg_loss_mel_ce:' || chr(27) || '[92m ' || value || ' ' || chr(27) || '[0m(-0.1)' ELSE ' > EPOCH: ' || (event_id % 40) || '/40' END
  WHEN 'view' THEN CASE WHEN event_id % 7 = 0 THEN '   | > loss_mel_ce: nan  (nan)' ELSE '   | > loss_mel_ce: ' || value || '  (1.0)' END
  ELSE ' > BEST MODEL : run/best_model_' || event_id || '.pth' END AS line FROM events"""
POINTS = f"""WITH raw AS ({LOG}),
c AS (SELECT log_id, line_no, regexp_replace(line, '\\x1b\\[[0-9;?]*[a-zA-Z]', '', 'g') AS line FROM raw),
m AS (SELECT *, CAST(nullif(regexp_extract(line, 'GLOBAL_STEP:\\s*(\\d+)', 1), '') AS BIGINT) AS st,
  CASE WHEN contains(line, 'EVALUATION') THEN true WHEN contains(line, 'EPOCH:') THEN false WHEN contains(line, 'GLOBAL_STEP') THEN false END AS fl FROM c),
k AS (SELECT *, coalesce(last_value(st IGNORE NULLS) OVER w, 0) AS step, coalesce(last_value(fl IGNORE NULLS) OVER w, false) AS in_eval,
  CAST(nullif(regexp_extract(line, 'BEST MODEL\\s*:.*?best_model_(\\d+)\\.pth', 1), '') AS BIGINT) AS best,
  nullif(regexp_extract(line, '>\\s*avg_loss_mel_ce:\\s*(\\S+)', 1), '') AS av, nullif(regexp_extract(line, '>\\s*loss_mel_ce:\\s*(\\S+)', 1), '') AS tr
  FROM m WINDOW w AS (PARTITION BY log_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
points AS (SELECT log_id, line_no, CASE WHEN best IS NOT NULL THEN 'best' WHEN av IS NOT NULL THEN CASE WHEN in_eval THEN 'eval' ELSE 'train' END WHEN tr IS NOT NULL THEN 'train' END AS series,
  coalesce(best, step) AS step, CASE WHEN best IS NULL THEN TRY_CAST(coalesce(av, tr) AS DOUBLE) END AS value
  FROM k WHERE best IS NOT NULL OR regexp_matches(coalesce(av, tr), '^[-+]?(\\d+\\.?\\d*|\\.\\d+)([eE][-+]?\\d+)?$'))"""

TRIMMED = f"""WITH b AS ({spans(600.0)}),
t AS (SELECT event_id, user_id, event_type, s, least(e, lead(s) OVER w) AS e2, coalesce(e > lead(s) OVER w, false) AS trimmed, e AS e1 FROM b WINDOW w AS (PARTITION BY user_id ORDER BY s, e, event_id)),
x AS (SELECT *, coalesce(e2, e1) AS e FROM t)"""

CHUNKS = f"""r AS (SELECT user_id, s, e, row_number() OVER (PARTITION BY user_id ORDER BY s, e) AS rn FROM ({spans(1.0)})),
f AS (
  SELECT user_id, rn, s AS c0, e AS c1, 0 AS chunk FROM r WHERE rn = 1
  UNION ALL
  SELECT r.user_id, r.rn, CASE WHEN r.e - f.c0 > 86400 THEN r.s ELSE f.c0 END, r.e, CASE WHEN r.e - f.c0 > 86400 THEN f.chunk + 1 ELSE f.chunk END
  FROM f JOIN r ON r.user_id = f.user_id AND r.rn = f.rn + 1),
chunks AS (SELECT user_id, chunk, min(c0) AS c0, arg_max(c1, rn) AS c1, count(*) AS n_regions FROM f GROUP BY user_id, chunk)"""

c1, c2, v1, v2 = AS_SCRIPT
AS_SCRIPT_SQL = f"translate(lower(text), '{c1 + v1},.', '{c2 + v2}්ං')"

GATES = [("mcd_db", False, 0.02, "rel"), ("f0_rmse_cents", False, 0.03, "rel"), ("f0_corr", True, 0.02, "abs"), ("secs", True, 0.01, "abs"), ("utmos", True, 0.05, "abs"), ("failure_rate", False, 0.01, "abs")]


def run_metrics(parity: int) -> str:
    return f"""SELECT metric, avg(value) AS value FROM (
  UNPIVOT (SELECT l_suppkey AS seed, avg(l_extendedprice) AS mcd_db, avg(l_quantity) AS f0_rmse_cents, avg(l_discount) AS f0_corr, avg(l_tax) AS secs, avg(l_quantity / 25) AS duration_ratio, CAST(count(*) AS DOUBLE) AS rtf
  FROM lineitem WHERE l_linenumber % 2 = {parity} GROUP BY l_suppkey) ON mcd_db, f0_rmse_cents, f0_corr, secs, duration_ratio, rtf INTO NAME metric VALUE value) GROUP BY metric"""


def dtw(vectors: int, width: int) -> str:
    """Alignment cost of neighbouring vectors, read as `vectors` rows of `width` numbers: one step for each anti-diagonal."""
    far = lambda i, j: "sqrt(" + " + ".join(f"(a[{i * width + k + 1}] - b[{j * width + k + 1}]) ** 2" for k in range(width)) + ")"
    steps = ["p AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS a, lag(CAST(embedding AS DOUBLE[])) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings)"]
    for d in range(2 * vectors - 1):
        cells = []
        for i in range(max(0, d - vectors + 1), min(d, vectors - 1) + 1):
            j = d - i
            before = [f"d_{x}_{y}" for x, y in ((i - 1, j), (i, j - 1), (i - 1, j - 1)) if x >= 0 and y >= 0]
            cells.append(far(i, j) + (f" + least({', '.join(before)})" if before else "") + f" AS d_{i}_{j}")
        steps.append(f"s{d} AS MATERIALIZED (SELECT *, {', '.join(cells)} FROM {'p WHERE b IS NOT NULL' if not d else f's{d - 1}'})")
    return f"WITH {', '.join(steps)} SELECT vec_id, round(d_{vectors - 1}_{vectors - 1}, 4) AS dtw FROM s{2 * vectors - 2}"


ORACLE = {
    "chunk_regions": f"WITH RECURSIVE {CHUNKS} SELECT user_id, chunk, c0, c1, n_regions FROM chunks",
    "region_chunk_overlap": f"""WITH RECURSIVE {CHUNKS}
SELECT c.user_id, chunk, count(*) AS n_regions, round(min(g.s), 6) AS first_start, round(max(g.e), 6) AS last_end
FROM chunks c JOIN ({spans(600.0)}) g ON c.user_id = g.user_id AND g.e > c.c0 AND g.s < c.c1 GROUP BY c.user_id, chunk""",
    "trim_overlap": f'{TRIMMED} SELECT event_id, user_id, round(s, 6) AS start, round(e, 6) AS "end", trimmed FROM x',
    "dedupe_spans": f"SELECT event_id, user_id FROM ({spans(1.0)}) QUALIFY row_number() OVER (PARTITION BY user_id, round_even(s / 1e5, 0), round_even(e / 1e5, 0) ORDER BY s, e, event_id) = 1",
    "snap_regions": f"""WITH RECURSIVE b AS ({spans(2000.0)}),
sen AS (SELECT user_id, s, e, lpad(CAST(event_id AS VARCHAR), 12, '0') AS text, row_number() OVER (PARTITION BY user_id ORDER BY s, e, event_id) AS si FROM b WHERE event_type IN ('click', 'signup')),
reg AS (SELECT user_id, s, e, row_number() OVER (PARTITION BY user_id ORDER BY s, e) AS ri FROM b WHERE event_type IN ('view', 'error')),
f AS (
  SELECT user_id, CAST(0 AS BIGINT) AS ri, CAST(1 AS BIGINT) AS cur, CAST(NULL AS BIGINT) AS won FROM (SELECT DISTINCT user_id FROM reg)
  UNION ALL
  SELECT f.user_id, reg.ri, coalesce(best.si, f.cur), best.si
  FROM f JOIN reg ON reg.user_id = f.user_id AND reg.ri = f.ri + 1
  LEFT JOIN LATERAL (SELECT arg_max(sen.si, (least(reg.e, sen.e) - greatest(reg.s, sen.s), -sen.si)) AS si FROM sen WHERE sen.user_id = f.user_id AND sen.si >= f.cur AND sen.s <= reg.e AND least(reg.e, sen.e) > greatest(reg.s, sen.s)) best ON true),
own AS (SELECT f.user_id, won AS si, arg_min(reg.s, reg.ri) AS a, arg_max(reg.e, reg.ri) AS b, count(*) AS n FROM f JOIN reg ON reg.user_id = f.user_id AND reg.ri = f.ri WHERE won IS NOT NULL GROUP BY f.user_id, won)
SELECT sen.user_id, text, round(coalesce(own.a, sen.s), 6) AS start, round(coalesce(own.b, sen.e), 6) AS "end", own.n IS NOT NULL AS snapped, coalesce(own.n, 0) AS n_regions FROM sen LEFT JOIN own USING (user_id, si)""",
    "merge_short": f"""WITH RECURSIVE r AS (SELECT user_id, s, e, event_type AS t, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY s, e, event_type) AS rn FROM ({spans(200.0)})),
f AS (
  SELECT user_id, rn, CAST(0 AS INTEGER) AS seq, s, e, CAST(t AS VARCHAR) AS t, ok FROM r WHERE rn = 1
  UNION ALL
  SELECT user_id, rn, CASE WHEN j THEN seq ELSE seq + 1 END, CASE WHEN j THEN ps ELSE s END, e, CASE WHEN j THEN pt || ' ' || t ELSE t END, CASE WHEN j THEN pok AND ok ELSE ok END
  FROM (SELECT r.user_id, r.rn, f.seq, f.s AS ps, f.t AS pt, f.ok AS pok, r.s, r.e, r.t, r.ok,
    (f.e - f.s < 20000 OR r.e - r.s < 20000) AND r.e - f.s <= 100000 AND r.s - f.e >= 0 AND r.s - f.e <= 50000 AS j FROM f JOIN r ON r.user_id = f.user_id AND r.rn = f.rn + 1))
SELECT user_id, seq, round(s, 6) AS start, round(e, 6) AS "end", t AS text, ok AS snapped FROM f QUALIFY row_number() OVER (PARTITION BY user_id, seq ORDER BY rn DESC) = 1""",
    "pad_neighbours": f"""{TRIMMED},
y AS (SELECT *, max(e) OVER (PARTITION BY user_id) - 500 AS total FROM x),
z AS (SELECT event_id, user_id, s, row_number() OVER w - 1 AS i, least(total, coalesce(lead(s) OVER w, total), e + 300) AS b FROM y WINDOW w AS (PARTITION BY user_id ORDER BY s, e, event_id)),
v AS (SELECT *, greatest(0.0, coalesce(lag(b) OVER (PARTITION BY user_id ORDER BY i), 0.0), s - 300) AS a FROM z)
SELECT event_id, user_id, i AS clip_index, 'user' || user_id || '__' || lpad(CAST(i AS VARCHAR), 4, '0') AS clip_id, round(a, 6) AS a, round(b, 6) AS b FROM v WHERE b - a >= 900""",
    "pad_fold": f"""WITH RECURSIVE {TRIMMED.removeprefix('WITH ')},
r AS (SELECT user_id, event_id, s, e, max(e) OVER (PARTITION BY user_id) - 500 AS total, row_number() OVER w AS rn, lead(s) OVER w AS nxt FROM x WINDOW w AS (PARTITION BY user_id ORDER BY s, e, event_id)),
q AS (SELECT *, least(total, coalesce(nxt, total), e + 300) AS b FROM r),
f AS (
  SELECT user_id, event_id, rn, greatest(0.0, s - 300) AS a, b, b - greatest(0.0, s - 300) >= 20000 AS keep, CASE WHEN b - greatest(0.0, s - 300) >= 20000 THEN b ELSE CAST(0.0 AS DOUBLE) END AS last FROM q WHERE rn = 1
  UNION ALL
  SELECT q.user_id, q.event_id, q.rn, greatest(0.0, f.last, q.s - 300), q.b, q.b - greatest(0.0, f.last, q.s - 300) >= 20000, CASE WHEN q.b - greatest(0.0, f.last, q.s - 300) >= 20000 THEN q.b ELSE f.last END
  FROM f JOIN q ON q.user_id = f.user_id AND q.rn = f.rn + 1)
SELECT event_id, user_id, rn - 1 AS clip_index, round(a, 6) AS a, round(b, 6) AS b FROM f WHERE keep""",
    "overlap_check": f"""SELECT user_id, count(*) AS violations FROM (SELECT user_id, s, lag(e) OVER (PARTITION BY user_id ORDER BY s, e, event_id) AS p FROM ({spans(600.0)})) WHERE s < p - 0.001 GROUP BY user_id""",
    "length_band": f"SELECT user_id, count(*) AS n FROM ({spans(1.0)}) WHERE e - s BETWEEN 3 AND 30 GROUP BY user_id",
    "coverage": f"""WITH b AS ({spans(60.0)}),
t AS (SELECT user_id, event_type, s, least(e, coalesce(lead(s) OVER (PARTITION BY user_id ORDER BY s, e, event_id), e)) AS e FROM b),
p AS (SELECT user_id, count(*) AS n_clips, sum(e - s) / 60 AS minutes, count(*) FILTER (event_type = 'error') AS unsnapped FROM t GROUP BY user_id),
q AS (SELECT user_id, max(e) - min(s) AS total FROM b GROUP BY user_id)
SELECT user_id, n_clips, unsnapped, round(minutes, 6) AS minutes, round(100 * (minutes / (total / 60)), 6) AS coverage FROM p JOIN q USING (user_id)""",
    "drop_reasons": f"SELECT doc_id, {manifest_tests(True)} AS drop_reason FROM ({MANIFEST})",
    "drop_counts": f"SELECT drop_reason, count(*) AS n FROM (SELECT doc_id, {manifest_tests(False)} AS drop_reason FROM ({MANIFEST})) WHERE drop_reason IS NOT NULL GROUP BY drop_reason",
    "corpus_cascade": "SELECT doc_id, " + cascade([("speaker!=en", "lang <> 'en'"), ("missing_wav", "toxic IS NULL"), ("unreadable_wav", "toxic <> 0"), ("longer_than_20s", "n_chars / 100.0 > 20"), ("shorter_than_1s", "n_chars / 100.0 < 1"), ("empty_text", "coalesce(text, '') = ''"), ("text_over_1500_chars", "length(text) > 1500")]) + " AS drop_reason FROM documents LEFT JOIN labels USING (doc_id)",
    "speaker_cascade": f"""WITH r AS (SELECT doc_id, {SCRIPTED} AS script, CASE WHEN lang <> 'de' THEN text END AS roman, n_chars / 100.0 AS seconds FROM documents),
x AS (SELECT *, CASE WHEN roman IS NULL THEN {fold_script('script')} ELSE {fold_roman('roman')} END AS folded FROM r)
SELECT doc_id, {cascade([("header_or_malformed", "NOT regexp_matches(script, '[඀-෿]')"), ("missing_wav", "doc_id % 11 = 0"), ("contains_digits", "regexp_matches(coalesce(roman, ''), '[0-9෦-෯]') OR regexp_matches(script, '[0-9෦-෯]')"), ("longer_than_40s", "seconds > 40"), ("shorter_than_1s", "seconds < 1"), ("unmapped_characters", f"roman IS NOT NULL AND regexp_matches(lower(roman), '[^\\x00-\\x7F{KNOWN}]')"), ("empty_after_fold", "folded = ''"), ("text_over_2000_chars", "length(folded) > 2000")])} AS drop_reason FROM x""",
    "best_source_files": r"""WITH f AS (SELECT source AS identifier, 'Part ' || (doc_id % 7) AS stem, 'a.b/Part ' || (doc_id % 7) || CASE lang WHEN 'de' THEN '.OGG' ELSE '.mp3' END AS name, CASE WHEN doc_id % 5 = 0 THEN 'original' ELSE 'derivative' END AS source,
  CASE WHEN doc_id % 13 = 0 THEN 0 ELSE n_chars END AS size, doc_id AS seq FROM documents WHERE lang <> 'fr'),
g AS (SELECT *, bool_or(source = 'original') OVER (PARTITION BY identifier) AS any_original FROM f)
SELECT identifier, stem, name, source, seq FROM g WHERE NOT any_original OR source = 'original' QUALIFY row_number() OVER (PARTITION BY identifier, stem ORDER BY size DESC, seq) = 1""",
    "originals_else_all": """SELECT user_id, count(*) AS n, round(sum(value), 6) AS total FROM (SELECT *, bool_or(event_type = 'purchase') OVER (PARTITION BY user_id) AS any_purchase FROM events) WHERE NOT any_purchase OR event_type = 'purchase' GROUP BY user_id""",
    "file_stems": r"""SELECT doc_id, 'Épisode ' || source || ' -- ' || doc_id || '.v1' AS stem, 'Épisode_' || source || '_' || doc_id || '_v1' AS episode, 'Épisode_' || source || '_' || doc_id || '_v1' AS of_clip FROM documents""",
    "wav_join": "SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN '/w/' || (d.doc_id % 500) || '/' || d.doc_id || '.wav' END AS wav, l.doc_id IS NULL AS missing FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)",
    "key_join": "SELECT p_brand, count(*) AS n, round(avg(l_quantity), 6) AS mean_quantity FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand",
    "missing_names": "SELECT c_custkey AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)",
    "speaker_dirs": r"""WITH p AS (SELECT DISTINCT regexp_replace('/src/' || regexp_replace(url, '^[a-z]+://|[?#].*$', '', 'g'), '/+$', '') AS path FROM pages),
d AS (SELECT path, len(string_split(path, '/')) AS depth, regexp_extract(path, '([^/]*)$', 1) AS name FROM p WHERE length(path) % 3 <> 0),
w AS (SELECT CAST(unnest(range(10, 100, 7)) AS VARCHAR) AS name)
SELECT w.name, arg_min(d.path, (d.depth, d.path)) AS path FROM w JOIN d ON contains(lower(d.name), lower(w.name)) GROUP BY w.name""",
    "resume_antijoin": "SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "cache_fill": "SELECT user_id, count(*) AS n, count(*) FILTER (event_id % 6 <> 0) AS called FROM events GROUP BY user_id",
    "episode_state": """WITH o AS (SELECT o_custkey AS episode, count(*) AS n_cached, bool_or(o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS marked, bool_or(o_orderstatus = 'O') AS written FROM orders GROUP BY o_custkey)
SELECT c_custkey AS episode, coalesce(n_cached, 0) AS n_cached, CASE WHEN marked THEN 'done' WHEN written AND coalesce(n_cached, 0) >= greatest(1, round_even(c_acctbal / 3 / 300, 0)) THEN 'backfill' ELSE 'redo' END AS status
FROM customer LEFT JOIN o ON o.episode = c_custkey""",
    "plan_estimate": """WITH u AS (SELECT d.doc_id, CASE WHEN d.doc_id % 17 <> 0 THEN CAST(n_chars AS DOUBLE) ELSE 0 END AS len, l.doc_id IS NOT NULL AS done FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id))
SELECT count(*) AS total, count(*) FILTER (done) AS skipped, round(sum(len) FILTER (NOT done) / 3600, 6) AS hours, CAST(sum(greatest(1, round_even(len / 300, 0))) FILTER (NOT done) AS BIGINT) AS requests FROM u""",
    "adopt_first": "SELECT l_suppkey AS episode, min('/out/' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0')) AS path FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) GROUP BY l_suppkey",
    "schema_union": "SELECT doc_id, coalesce(quality, 'hifi') AS quality, coalesce(snapped, 'True') AS snapped FROM (SELECT doc_id, lang AS quality FROM documents WHERE doc_id % 2 = 0 UNION ALL BY NAME SELECT doc_id, source AS snapped FROM documents WHERE doc_id % 2 = 1)",
    "manifest_summary": f"""WITH m AS (SELECT TRY_CAST(duration AS DOUBLE) AS d, coalesce(quality, 'hifi') AS quality, coalesce(snapped, 'True') AS snapped FROM ({MANIFEST}))
SELECT count(*) AS clips, round(sum(d) / 3600, 6) AS hours, round(sum(d) FILTER (quality = 'hifi') / 3600, 6) AS hifi_hours, round(sum(d) FILTER (quality = 'lofi') / 3600, 6) AS lofi_hours, count(*) FILTER (snapped <> 'True') AS unsnapped FROM m""",
    "failover_pairs": "SELECT n_nationkey, r_regionkey, row_number() OVER (ORDER BY n_nationkey, r_regionkey) AS turn FROM nation, region",
    "stat_blocks": """SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'all' ELSE l_returnflag END AS name, count(x) AS n, round(avg(x), 6) AS mean, round(median(x), 6) AS median, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max
FROM (SELECT l_returnflag, CASE WHEN l_discount > 0.01 THEN l_extendedprice END AS x FROM lineitem) GROUP BY GROUPING SETS ((l_returnflag), ())""",
    "failure_rate": """WITH r AS (SELECT l_returnflag, CASE WHEN l_linenumber <> 3 THEN l_extendedprice / greatest(l_quantity * 1000, 1e-6) END AS q FROM lineitem)
SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'all' ELSE l_returnflag END AS l_returnflag, count(*) AS clips, round(sum(CASE WHEN q < 0.7 OR q > 1.4 THEN 1 ELSE 0 END) / greatest(count(*), 1), 6) AS failure_rate FROM r GROUP BY GROUPING SETS ((l_returnflag), ())""",
    "index_percentiles": """WITH g AS (SELECT lang, list_sort(list(n_chars)) AS l, count(*) AS n FROM documents GROUP BY lang)
SELECT lang, l[n // 2 + 1] AS median, l[CAST(floor(n * 0.95) AS BIGINT) + 1] AS p95, l[CAST(floor((n - 1) * 0.95) AS BIGINT) + 1] AS p95_last FROM g""",
    "cer_gaps": """WITH r AS (SELECT l_returnflag, CASE WHEN l_linenumber <> 2 THEN l_tax END - l_discount AS g FROM lineitem)
SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'all' ELSE l_returnflag END AS name, count(*) AS clips, round(count(*) FILTER (g > 0.02) / count(*), 6) AS failure_rate, count(g) AS n, round(avg(g), 6) AS mean, round(stddev_pop(g), 6) AS std
FROM r GROUP BY GROUPING SETS ((l_returnflag), ())""",
    "training_plan": """WITH p AS (SELECT lang, greatest(1, count(*) // 8) AS steps FROM documents GROUP BY lang)
SELECT lang, steps AS steps_per_epoch, round(steps * 40 * 1.42 / 3600, 6) AS total_hours, CAST(greatest(1, ceil(steps * 40 * 1.42 / 3600 / 0.5)) AS BIGINT) AS sessions FROM p""",
    "episode_counts": """WITH e AS (SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS failed FROM orders GROUP BY o_custkey)
SELECT count(*) FILTER (NOT failed) AS complete, count(*) FILTER (failed) AS partial FROM e""",
    "scored_transcripts": f"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 0.0 ELSE 1.0 END AS accuracy FROM documents WHERE text IS NOT NULL AND doc_id % 5 <> 0 AND (text <> '' OR doc_id % 3 = 0)""",
    "kept_durations": """SELECT l.doc_id AS clip_id, arg_max(l_extendedprice, (l_linenumber, l_extendedprice)) AS duration FROM (SELECT doc_id FROM labels WHERE quality = 1) l JOIN lineitem ON l_orderkey = l.doc_id GROUP BY l.doc_id""",
    "conditioning_clip": """WITH r AS (SELECT doc_id, source, (doc_id * 7919) % 10007 AS o FROM labels JOIN documents USING (doc_id)),
n AS (SELECT doc_id, source, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS other FROM r WINDOW w AS (PARTITION BY source ORDER BY o, doc_id))
SELECT doc_id, source, CASE WHEN other <> doc_id THEN other END AS conditioning FROM n""",
    "manifest_round_trip": "SELECT doc_id, lang, coalesce(length(trim(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), ' ')), 0) AS n FROM documents",
    "cache_round_trip": "SELECT user_id AS episode, count(*) AS n, max(event_id) AS last_chunk FROM events WHERE user_id % 50 = 1 GROUP BY user_id",
    "report_round_trip": "SELECT source, count(*) AS clips, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source",
    "exact_rounds": "SELECT event_id, round(value, 2) AS rounded FROM events",
    "dtw_distance": dtw(8, 8),
    "speaker_hours": "SELECT source, count(*) AS clips, round(sum(n_chars) / 3600, 6) AS hours, median(n_chars) AS median, max(n_chars) AS longest FROM documents GROUP BY source",
    "pooled_ratings": """WITH r AS (SELECT lang, quality * 4 + 1 AS x FROM labels JOIN documents USING (doc_id))
SELECT CASE WHEN grouping(lang) = 1 THEN 'all' ELSE lang END AS lang, count(x) AS n, round(avg(x), 6) AS mean, round(100 * avg(x) / 5, 6) AS percent, round(stddev_pop(x), 6) AS sd FROM r GROUP BY GROUPING SETS ((lang), ())""",
    "rater_groups": 'SELECT "group", count(*) AS raters FROM (SELECT user_id, arg_max(event_type, event_id) AS "group" FROM events GROUP BY user_id) GROUP BY "group"',
    "disagreement_topk": "SELECT l_partkey, count(l_quantity) AS n, round(stddev_pop(l_quantity), 6) AS sd FROM lineitem GROUP BY l_partkey HAVING count(l_quantity) > 2 ORDER BY stddev_pop(l_quantity) DESC, l_partkey LIMIT 5",
    "least_intelligible": "SELECT l_suppkey, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY l_suppkey ORDER BY avg(l_quantity), l_suppkey LIMIT 5",
    "ordered_distinct": "SELECT user_id, min(event_id) AS first_seen FROM events GROUP BY user_id",
    "character_counts": "SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(lower(text), '')) AS ch FROM documents) WHERE ch <> '' GROUP BY ch",
    "unmapped_chars": f"SELECT ch, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[^\\x00-\\x7F{KNOWN}]')) AS ch FROM documents) GROUP BY ch",
    "modal_width": f"""WITH l AS ({LINES}), w AS (SELECT file, CAST(len(string_split(line, ',')) AS BIGINT) AS width, count(*) AS n, min(line_no) AS seen FROM l WHERE line <> '' GROUP BY ALL)
SELECT file, width, n, CAST(sum(n) OVER (PARTITION BY file) AS BIGINT) AS rows FROM w QUALIFY row_number() OVER (PARTITION BY file ORDER BY n DESC, seen) = 1""",
    "epoch_plan": "SELECT lang, greatest(1, count(*) // 8) AS steps FROM documents GROUP BY lang",
    "first_rates": "SELECT sample_rate, count(*) AS n FROM (SELECT CAST([16000, 22050, 44100][n_chars % 3 + 1] AS BIGINT) AS sample_rate FROM documents ORDER BY doc_id LIMIT 200) GROUP BY sample_rate",
    "speaker_overview": """SELECT source AS speaker, round(avg(n_chars), 6) AS score, round(sum(n_chars) FILTER (lang = 'en') / 3600, 6) AS hours, CASE WHEN count(*) FILTER (lang = 'de' AND doc_id % 2 = 0) > 0 THEN 'script' END AS text_source
FROM documents GROUP BY source""",
    "slim_tensors": """WITH t AS (SELECT p_size % 3 = 0 AS kept, CASE WHEN p_partkey % 2 = 0 THEN 'float32' ELSE 'int64' END AS dtype, p_size AS n, 'gpt.' || p_partkey AS name FROM part)
SELECT kept, dtype, count(*) AS n, CAST(sum(n * CASE dtype WHEN 'float32' THEN 4 ELSE 8 END) AS BIGINT) AS bytes_before, CAST(sum(CASE WHEN NOT kept THEN 0 WHEN dtype = 'float32' THEN n * 2 ELSE n * 8 END) AS BIGINT) AS bytes_after, min(CASE WHEN kept THEN name END) AS first_name
FROM t GROUP BY kept, dtype""",
    "train_eval_split": "SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY (doc_id * 7919) % 10007, doc_id) <= least(40, count(*) OVER (PARTITION BY lang) // 10) AS is_eval FROM documents",
    "seeded_split": "SELECT lang, count(*) AS n, least(40, count(*) // 10) AS n_eval FROM documents GROUP BY lang",
    "terciles": f"""WITH w AS (SELECT doc_id, lang, len({words('text')}) AS n_words FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_words, doc_id) AS rn, greatest(1, count(*) OVER (PARTITION BY lang) // 3) AS t FROM w)
SELECT doc_id, n_words, CAST(CASE WHEN rn <= t THEN 0 WHEN rn <= 2 * t THEN 1 ELSE 2 END AS BIGINT) AS third FROM r""",
    "first_per_group": "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3",
    "interleave_pairs": f"""WITH w AS (SELECT item_id, {words('text')} AS ws FROM benchmark), k AS (SELECT *, len(ws) AS n_words, row_number() OVER (PARTITION BY len(ws) ORDER BY item_id) - 1 AS k FROM w WHERE len(ws) BETWEEN 5 AND 60),
j AS (SELECT a.n_words, a.item_id AS a_id, b.item_id AS b_id, array_to_string(list_transform(range(1, a.n_words + 1), lambda i: CASE WHEN i % 2 = 1 THEN a.ws[i] ELSE b.ws[i] END), ' ') AS s FROM k a JOIN k b ON a.n_words = b.n_words AND b.k = a.k + 1 WHERE a.k % 2 = 0)
SELECT n_words, a_id, b_id, CASE WHEN ends_with(rtrim(s), '.') THEN s ELSE regexp_replace(s, '[ .,]+$', '') || '.' END AS sentence FROM j""",
    "longest_text": "SELECT source, doc_id, length(text) AS n FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id) = 1",
    "fold_roman": f"SELECT doc_id, {fold_roman('text')} AS folded FROM documents",
    "normalise_text": f"SELECT doc_id, {spoken('text')} AS spoken FROM documents",
    "fold_script": f"SELECT doc_id, CASE WHEN regexp_matches(x, '[඀-෿]') THEN {fold_script('x')} ELSE {fold_roman('x')} END AS folded FROM (SELECT doc_id, {AS_SCRIPT_SQL} AS x FROM documents)",
    "escaped_html": "SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;') AS escaped, to_base64(encode(url)) AS encoded FROM pages",
    "delimiter_sniff": f"""WITH l0 AS ({LINES}), l AS (SELECT file, line_no, translate(translate(line, 'ETOA', 'එටඔඅ'), '"', chr(39)) AS line FROM l0),
d AS (SELECT file, line_no, delim, ord, string_split(line, delim) AS cells FROM l, (VALUES ('|', 0), (chr(9), 1), (';', 2), (',', 3)) AS v(delim, ord) WHERE trim(replace(line, delim, '')) <> ''),
w AS (SELECT file, delim, ord, len(cells) AS width, count(*) AS n, min(line_no) AS seen FROM d GROUP BY ALL),
m AS (SELECT *, sum(n) OVER (PARTITION BY file, ord) AS rows FROM w QUALIFY row_number() OVER (PARTITION BY file, ord ORDER BY n DESC, seen) = 1),
g AS (SELECT d.file, d.ord, d.cells, d.line_no, m.width FROM d JOIN m ON d.file = m.file AND d.ord = m.ord AND len(d.cells) = m.width WHERE m.width >= 2 QUALIFY row_number() OVER (PARTITION BY d.file, d.ord ORDER BY d.line_no) <= 200),
c AS (SELECT file, ord, width, unnest(cells) AS cell, unnest(range(len(cells))) AS i FROM g),
h AS (SELECT file, ord, width, i, count(*) FILTER (regexp_matches(cell, '[඀-෿]')) AS sc, count(*) FILTER (NOT regexp_matches(cell, '[඀-෿]') AND regexp_matches(cell, '(?i)[āīūēōæǣñśşḍḥḷṁṅṇṉṛṝṭ]')) AS ro FROM c GROUP BY ALL),
t AS (SELECT file, ord, width, max(sc) AS sc, max(ro) AS ro, arg_max(i, (sc, -i)) AS script_col, arg_max(i, (ro, -i)) AS rc FROM h GROUP BY ALL),
u AS (SELECT *, CASE WHEN ro > 0 AND rc <> script_col THEN rc END AS roman_col FROM t WHERE sc > 0),
s AS (SELECT u.file, m.delim, u.ord, u.width, m.n / m.rows AS share, u.script_col, u.roman_col, coalesce((SELECT min(x) FROM unnest(range(u.width)) AS r(x) WHERE x <> u.script_col AND x IS DISTINCT FROM u.roman_col), 0) AS id_col FROM u JOIN m ON u.file = m.file AND u.ord = m.ord)
SELECT file, delim, width, round(share, 6) AS share, id_col, script_col, roman_col FROM s QUALIFY row_number() OVER (PARTITION BY file ORDER BY (roman_col IS NOT NULL) DESC, share DESC, width DESC, ord) = 1""",
    "log_series": f"{POINTS} SELECT log_id, line_no, series, step, value FROM points",
    "log_verdicts": f"""{POINTS},
e AS (SELECT log_id, value, row_number() OVER (PARTITION BY log_id ORDER BY line_no) - 1 AS i FROM points WHERE series = 'eval'),
g AS (SELECT log_id, count(*) AS points, min(value) AS best, arg_max(value, i) AS last, count(*) - 1 - arg_min(i, (value, i)) AS after FROM e GROUP BY log_id)
SELECT log_id, points, best, last, after, CASE WHEN points < 3 THEN 'too-short' WHEN after = 0 THEN 'improving' WHEN after >= 2 AND last > best * 1.01::DOUBLE THEN 'overfitting' ELSE 'plateau' END AS verdict FROM g""",
    "log_divergence": f"""WITH raw AS ({LOG}), v AS (SELECT log_id, line_no, regexp_extract(regexp_replace(line, '\\x1b\\[[0-9;?]*[a-zA-Z]', '', 'g'), 'loss_mel_ce:\\s*(\\S+)', 1) AS x FROM raw)
SELECT log_id, NOT regexp_matches(arg_max(x, line_no), '^[-+]?(\\d+\\.?\\d*|\\.\\d+)([eE][-+]?\\d+)?$') AS diverged FROM v WHERE x <> '' GROUP BY log_id""",
    "log_summary": f"""{POINTS},
tr AS (SELECT log_id, arg_min(step, line_no) AS a, arg_max(step, line_no) AS b FROM points WHERE series = 'train' GROUP BY log_id),
ev AS (SELECT user_id AS log_id, count(*) FILTER (event_type = 'signup') AS n, epoch(arg_max(date_trunc('second', ts), event_id) FILTER (event_type = 'signup')) - epoch(arg_min(date_trunc('second', ts), event_id) FILTER (event_type = 'signup')) AS sec,
  arg_max(event_id % 40, event_id) FILTER (event_type = 'purchase' AND event_id % 2 = 1) AS ep FROM events GROUP BY user_id)
SELECT log_id, round(CASE WHEN n >= 2 THEN sec / 3600 END, 6) AS wall_h, round(CASE WHEN n >= 2 AND b > a THEN sec / (b - a) END, 6) AS sec_per_step, coalesce(b, 0) AS last_step, ep AS epoch_reached, CASE WHEN ep IS NOT NULL THEN CAST(41 AS BIGINT) END AS epoch_total
FROM ev LEFT JOIN tr USING (log_id)""",
    "log_lines_shown": f"""WITH raw AS ({LOG}), c AS (SELECT log_id, line_no, trim(regexp_replace(line, '\\x1b\\[[0-9;?]*[a-zA-Z]', '', 'g')) AS line FROM raw)
SELECT log_id, line_no, line FROM c WHERE regexp_matches(line, 'loss_mel_ce|EPOCH|EVAL|BEST|STEP:') AND NOT regexp_matches(line, 'it/s|iB/s') QUALIFY row_number() OVER (PARTITION BY log_id ORDER BY line_no DESC) <= 3""",
    "rolling_mean": "SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS smooth FROM events",
    "best_checkpoints": """WITH f AS (SELECT o_custkey AS run, o_orderkey AS k, o_orderstatus = 'F' AND o_orderkey % 3 = 0 AS best FROM orders)
SELECT run, '/r/' || CASE WHEN best THEN 'best_model_' ELSE 'checkpoint_' END || k || '.pth' AS path FROM f QUALIFY row_number() OVER (PARTITION BY run ORDER BY best DESC, k DESC) = 1""",
    "finite_numbers": r"""WITH w AS (SELECT event_id, [CAST(value AS VARCHAR), 'nan', '-inf', '1.5f', '.5', '-3e5', ''][event_id % 7 + 1] AS x FROM events)
SELECT event_id, regexp_matches(x, '^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$') AS finite, TRY_CAST(nullif(regexp_extract(x, '(\d+)', 1), '') AS BIGINT) AS whole FROM w""",
    "regression_gates": f"""WITH b AS ({run_metrics(0)}), c AS ({run_metrics(1)}), g(metric, hb, tol, kind) AS (VALUES {", ".join(f"('{m}', {h}, CAST({t} AS DOUBLE), '{k}')" for m, h, t, k in GATES)}),
j AS (SELECT b.metric, b.value AS x, c.value AS y, hb, tol, kind FROM b JOIN c USING (metric) LEFT JOIN g USING (metric)),
k AS (SELECT *, CASE WHEN metric = 'duration_ratio' THEN 0.02::DOUBLE WHEN kind = 'rel' THEN tol * abs(x) ELSE tol END AS allowed, CASE WHEN metric = 'duration_ratio' THEN abs(1 - y) - abs(1 - x) WHEN hb THEN x - y WHEN NOT hb THEN y - x END AS worse FROM j)
SELECT metric, round(x, 6) AS baseline, round(y, 6) AS candidate, round(allowed, 6) AS allowed, round(worse, 6) AS worse_by, worse <= allowed AS ok FROM k""",
    "findings": """WITH s AS (SELECT lang, sum(n_chars) / 36000 AS hours, avg(n_chars / 10000.0) AS corr FROM documents GROUP BY lang), m AS (SELECT count(*) FILTER (n_chars > 2000) / count(*) AS fail FROM documents)
SELECT CAST(0 AS BIGINT) AS seq, 'investigate' AS severity, 'Some text came from transliterated script' AS title FROM s WHERE lang = 'de'
UNION ALL SELECT 1, 'consider', 'Speaker data is imbalanced: least for ' || arg_min(lang, (hours, lang)) FROM s HAVING count(*) > 1 AND max(hours) > 2 * min(hours)
UNION ALL SELECT 2, 'do first', 'Training used a small part of its time budget'
UNION ALL SELECT 3, 'do first', 'The run stopped before it converged'
UNION ALL SELECT 6, 'do first', 'The epochs asked for need more than one session'
UNION ALL SELECT 7, 'investigate', 'Many generations failed' FROM m WHERE fail > 0.03
UNION ALL SELECT 8, 'investigate', 'Generated audio is systematically shorter or longer'
UNION ALL SELECT 9, 'investigate', 'Speakers differ in prosody: ' || arg_min(lang, corr) || ' and ' || arg_max(lang, corr) FROM s HAVING count(*) > 1 AND max(corr) - min(corr) > 0.15""",
    "cosine_prev": """WITH e AS (SELECT vec_id, embedding AS a, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings)
SELECT vec_id, round(list_cosine_similarity(CAST(a AS DOUBLE[]), CAST(b AS DOUBLE[])), 5) AS cosine FROM e WHERE b IS NOT NULL""",
    "pitch_stats": """WITH p AS (SELECT user_id, value AS a, lead(value) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events)
SELECT user_id, count(*) AS n, round(sqrt(avg(1200 * log2(b / a) * 1200 * log2(b / a))), 4) AS rmse, round(corr(ln(a), ln(b)), 6) AS corr FROM p WHERE b IS NOT NULL AND a > 0 AND b > 0 GROUP BY user_id""",
    "json_items": """WITH k AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
i AS (SELECT event_id, k % 50 + 10.0::DOUBLE AS s, k + 10.0::DOUBLE AS e, 'item ' || event_id AS text FROM k WHERE event_id % 5 <> 0)
SELECT event_id, CAST(0 AS BIGINT) AS seq, greatest(s, 10) AS start, least(e, 80) AS "end", text FROM i WHERE e > s AND least(e, 80) > greatest(s, 10)""",
    "quota_errors": "SELECT event_id, CAST(event_id % 60 AS DOUBLE) AS delay, event_id % 3 = 0 AS daily FROM events",
    "quality_tags": """WITH r AS (SELECT [8000, 16000, 22050, 24000, 44100][doc_id % 5 + 1] AS rate, n_chars FROM documents)
SELECT CASE WHEN rate >= 22050 THEN 'hifi' ELSE 'lofi' END AS quality, CAST(least(24000, rate) AS BIGINT) AS output_rate, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM r GROUP BY ALL""",
    "metric_unwrap": "SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN value END AS secs FROM events",
    "next_reset": """WITH t AS (SELECT event_id, epoch_us(ts) AS us, ts - INTERVAL 8 HOUR AS local FROM events)
SELECT event_id, round((epoch_us(date_trunc('day', local) + INTERVAL 1 DAY + INTERVAL 8 HOUR) - us) / 1e6, 6) AS seconds_left FROM t""",
    "streaming_counts": "SELECT epoch_us(ts) // 300000000 * 300 AS window_start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL",
}

ORACLE["gates_overall"] = f"SELECT count(ok) AS compared, count(*) FILTER (NOT ok) AS failed, coalesce(bool_and(coalesce(ok, true)), true) AS passed FROM ({ORACLE['regression_gates']})"
ORACLE["stream_divergence"] = ORACLE["log_divergence"].replace("SELECT log_id, NOT", "SELECT log_id, count(*) AS seen, NOT")
