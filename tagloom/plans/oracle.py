"""The registered queries restated in plain SQL over the same tables."""

from __future__ import annotations

import re

# --- views -------------------------------------------------------------------------------------

VIEWS = {
    "sent": r"""
SELECT doc_id::VARCHAR || '.s' || ln::VARCHAR AS sid, text FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
         unnest(range(len(string_split(text, chr(10))))) AS ln
  FROM documents) WHERE trim(text) <> ''""",
    "piece": r"""
SELECT sid, unnest(p) AS form, unnest(range(len(p))) AS k FROM (
  SELECT sid, regexp_extract_all(text, '\s+|[\p{L}\p{N}]+|[^\s\p{L}\p{N}]') AS p FROM sent)""",
    "tok": r"""
SELECT sid, (row_number() OVER (PARTITION BY sid ORDER BY k) - 1)::INTEGER AS tok_ix, form,
       (e - length(form))::INTEGER AS start, (e - 1)::INTEGER AS "end"
FROM (SELECT sid, k, form, sum(length(form)) OVER (PARTITION BY sid ORDER BY k) AS e FROM piece)
WHERE NOT regexp_full_match(form, '\s+')""",
    "voc": r"""
SELECT term, (['drug', 'brand', 'group', 'drug_n'])[length(term) % 4 + 1] AS type FROM (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM benchmark)""",
    "lex": "SELECT * FROM voc WHERE length(term) >= 8",
    "ahead": r"""
SELECT *, lead(form) OVER w AS nform, lead(start) OVER w AS nstart, lead("end") OVER w AS nend
FROM tok WINDOW w AS (PARTITION BY sid ORDER BY tok_ix)""",
    "gold": r"""
SELECT a.sid, a.tok_ix AS ent_ix, a.start, a."end" AS own_end, l.type,
       CASE WHEN regexp_matches(coalesce(nform, ''), '^\p{L}') THEN nend ELSE a."end" END AS "end",
       CASE WHEN regexp_matches(coalesce(nform, ''), '^\p{L}') THEN nstart END AS nstart,
       a.form || CASE WHEN regexp_matches(coalesce(nform, ''), '^\p{L}') THEN ' ' || nform ELSE '' END AS joined
FROM ahead a JOIN lex l ON lower(a.form) = l.term""",
    "tagged": r"""
SELECT t.*, coalesce(b.tag, 'O') AS tag FROM tok t LEFT JOIN (
  SELECT t.sid, t.tok_ix, (CASE WHEN t.start = g.start THEN 'B-' ELSE 'I-' END) || g.type AS tag,
         row_number() OVER (PARTITION BY t.sid, t.tok_ix ORDER BY g.ent_ix) AS r
  FROM tok t JOIN gold g ON t.sid = g.sid AND t.start >= g.start AND t."end" <= g."end") b
ON t.sid = b.sid AND t.tok_ix = b.tok_ix AND b.r = 1""",
    "guess": r"""
SELECT sid, tok_ix, form, start, "end",
  CASE WHEN length(form) % 5 = 0 THEN 'O'
       WHEN length(form) % 7 = 0 AND tag LIKE 'I-%' THEN 'B-' || substr(tag, 3) ELSE tag END AS label
FROM tagged""",
    "numbered": """
SELECT *, (row_number() OVER (PARTITION BY sid ORDER BY ent_ix) - 1)::INTEGER AS ix FROM gold""",
    "ent": r"""
SELECT g.sid, ent_ix, g.sid || '.e' || ent_ix AS id, start, "end", type,
  start || '-' || own_end || CASE WHEN nstart IS NULL THEN '' ELSE ';' || nstart || '-' || "end" END AS "offset",
  substr(s.text, start + 1, "end" - start + 1) AS text
FROM gold g JOIN sent s USING (sid)""",
    "rel": r"""
SELECT sid, id AS e1, nid AS e2, (ent_ix + nix) % 3 <> 0 AS ddi,
  (['advise', 'effect', 'mechanism', 'int'])[(ent_ix + nix) % 4 + 1] AS type
FROM (SELECT *, lead(id) OVER w AS nid, lead(ent_ix) OVER w AS nix FROM ent
      WINDOW w AS (PARTITION BY sid ORDER BY ent_ix)) WHERE nid IS NOT NULL""",
    "forms": "SELECT form, count(*) AS n FROM tok GROUP BY form",
    "shaped": r"""
SELECT t.*, lower(form) AS low, @casing(form) AS casing FROM tagged t""",
    "around": r"""
SELECT *, lag(form, 2) OVER w AS p2, lag(form) OVER w AS p1, lead(form) OVER w AS n1, lead(form, 2) OVER w AS n2,
  lag(low, 2) OVER w AS lp2, lag(low) OVER w AS lp1, lead(low) OVER w AS ln1,
  lag(casing) OVER w AS cp1, lead(casing) OVER w AS cn1
FROM shaped WINDOW w AS (PARTITION BY sid ORDER BY tok_ix)""",
    "goldkey": r"""SELECT DISTINCT sid, start, "end", start || '-' || "end" AS "offset", joined AS text, type FROM gold""",
    "stat_guess": "@stats(goldkey, decoded)",
    "extern": r"""
SELECT DISTINCT term FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM conversations)""",
    "tags": r"""
SELECT form, lang AS pos FROM (
  SELECT form, lang, row_number() OVER (PARTITION BY form ORDER BY n DESC, lang) AS r FROM (
    SELECT form, lang, count(*) AS n FROM (
      SELECT lang, unnest(regexp_extract_all(text, '\p{L}+')) AS form FROM documents) GROUP BY ALL)) WHERE r = 1""",
    "vec": r"""
SELECT term AS word, e.embedding::DOUBLE[] AS vec
FROM (SELECT term, row_number() OVER (ORDER BY term) - 1 AS r FROM voc) x JOIN embeddings e ON e.vec_id = x.r""",
}

# --- fixed values: the feature keys, which must equal those of the templates ---
CONTEXT = [
    "'formPrev=' || p1", "'formLowerPrev=' || lp1", "'casingPrev=' || cp1", "'bigram=' || lp1 || '_' || low",
    "'formPrev2=' || p2", "'trigram=' || lp2 || '_' || lp1 || '_' || low", "CASE WHEN p1 IS NULL THEN 'BoS' END",
    "'formNext=' || n1", "'formLowerNext=' || ln1", "'casingNext=' || cn1", "'formNext2=' || n2",
    "CASE WHEN n1 IS NULL THEN 'EoS' END",
]


def _affix(kind: str, n: int, x: str = "form") -> str:
    cut = f"substr({x}, 1, {n})" if kind == "pref" else f"right({x}, {n})"
    return f"CASE WHEN length({x}) >= {n} THEN lower({cut}) END"


def _gram(k: int) -> str:
    more = " WHEN length(form) < 2 THEN lower(form)" if k == 0 else ""
    return f"CASE WHEN length(form) >= {k + 2} THEN lower(substr(form, {k + 1}, 2)){more} END"


def _casing(x: str) -> str:
    u, lo, t = (f"regexp_matches({x}, '\\p{{{c}}}')" for c in ("Lu", "Ll", "Lt"))
    title = rf"regexp_full_match({x}, '[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]*[\p{{Lu}}\p{{Lt}}]\p{{Ll}}*(?:[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+[\p{{Lu}}\p{{Lt}}]\p{{Ll}}*)*[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]*')"
    return (
        f"(CASE WHEN {u} AND NOT {lo} AND NOT {t} THEN 'ALLCAPS' WHEN {title} THEN 'TITLE' "
        f"WHEN {lo} AND NOT {u} AND NOT {t} THEN 'LOWER' WHEN {u} THEN 'MIXED' ELSE 'NOCASE' END)"
    )


def _shape(x: str) -> str:
    up = rf"regexp_replace({x}, '\p{{Lu}}', 'X', 'g')"
    low = rf"regexp_replace({up}, '[\p{{Ll}}\p{{Lt}}\p{{Lm}}\p{{Lo}}]', 'x', 'g')"
    return rf"regexp_replace({low}, '[\p{{Nd}}²³¹]', 'd', 'g')"


FLAGS = {
    "hasDigit": r"regexp_matches(form, '[\p{Nd}²³¹]')",
    "hasHyphen": "contains(form, '-')",
    "hasParenthesis": "(contains(form, '(') OR contains(form, ')'))",
    "hasBracket": "(contains(form, '[') OR contains(form, ']'))",
    "isLongWord": "length(form) > 10",
}

BASIC = ["'form=' || form", "'formLower=' || low"] + [
    f"'{kind}{n}=' || {_affix(kind, n)}" for n in (3, 4, 5) for kind in ("pref", "suf")
]
CHARACTER = (
    [f"'char2gram=' || {_gram(k)}" for k in range(5)]
    + [f"'wordShape=' || {_shape('form')}", "'casing=' || casing"]
    + [f"CASE WHEN {cond} THEN '{key}=true' END" for key, cond in FLAGS.items()]
)
# --- end of fixed values ---
ALL = BASIC + CHARACTER + CONTEXT


def _list(parts: list[str]) -> str:
    return "list_filter([" + ", ".join(parts) + "], lambda f: f IS NOT NULL)"


VIEWS["feats"] = f'SELECT sid, tok_ix, form, start, "end", tag, {_list(ALL)} AS f FROM around'
VIEWS["charfeats"] = f"SELECT sid, tok_ix, tag, {_list(BASIC + CHARACTER)} AS f FROM shaped"
VIEWS["chain"] = "SELECT sid, tok_ix, tag, f FROM feats"


def _rewritten(f: str) -> str:
    tab = "chr(9)"
    line = f"array_to_string({f}, {tab})"
    line = f"replace({line}, 'BoS', 'formPrev=BoS' || {tab} || 'suf3Prev=BoS')"
    return f"string_split(replace({line}, 'EoS', 'formNext=EoS' || {tab} || 'suf3Next=EoS'), {tab})"


def _one_hot(source: str, phase: str, extra: str = "") -> str:
    """Long rows ``key, value`` of a feature view after the last-value rule."""
    features = _rewritten("f") + ("[2:]" if phase == "predict" else "")
    value = "split_part(x, '=', 2)" if phase == "train" else "substr(x, strpos(x, '=') + 1)"
    return (
        f"SELECT * EXCLUDE (pos, last) FROM (SELECT *, max(pos) OVER (PARTITION BY sid, tok_ix, key) AS last FROM ("
        f"SELECT sid, tok_ix, tag, pos, split_part(x, '=', 1) AS key, {value} AS value FROM ("
        f"SELECT sid, tok_ix, tag, unnest(g) AS x, unnest(range(len(g))) AS pos FROM (SELECT sid, tok_ix, tag, {features} AS g FROM {source}))))"
        f" WHERE pos = last"
    )


VIEWS["trainf"] = _one_hot("feats", "train")
VIEWS["predf"] = _one_hot("feats", "predict")
VIEWS["chartrainf"] = _one_hot("charfeats", "train")


def _nb(source: str, p: str, tags: str = "tagged") -> dict[str, str]:
    return {
        f"{p}cnt": f"SELECT tag, key, key || '=' || value AS feature, count(*) AS n FROM {source} GROUP BY ALL",
        f"{p}v": f"SELECT count(DISTINCT feature) AS v FROM {p}cnt",
        f"{p}den": f"SELECT tag, ln(sum(n) + 0.01 * any_value(v)) AS denom FROM {p}cnt, {p}v GROUP BY tag",
        f"{p}logp": f"SELECT feature, key, tag, n, ln(n + 0.01) - denom AS logp FROM {p}cnt JOIN {p}den USING (tag)",
        f"{p}default": f"SELECT tag, ln(0.01) - denom AS logp FROM {p}den",
        f"{p}prior": f"SELECT tag, ln(count(*)) - ln(sum(count(*)) OVER ()) AS logp FROM {tags} GROUP BY tag",
    }


VIEWS.update(_nb("trainf", "nb"))
VIEWS.update(_nb("chartrainf", "ch"))


def _predict(pred: str, model: str) -> str:
    """Score every token and take the best label of the rounded scores."""
    return f"""
SELECT sid, tok_ix, tag AS label, score FROM (
  SELECT *, row_number() OVER (PARTITION BY sid, tok_ix ORDER BY score DESC, tag) AS r FROM (
    SELECT b.sid, b.tok_ix, p.tag, round(p.logp + b.n * d.logp + coalesce(g.gain, 0), 6) AS score
    FROM (SELECT t.sid, t.tok_ix, coalesce(n, 0) AS n FROM tok t LEFT JOIN (
            SELECT sid, tok_ix, count(*) AS n FROM {pred} p
            WHERE p.key || '=' || p.value IN (SELECT feature FROM {model}cnt) GROUP BY ALL) m USING (sid, tok_ix)) b
    CROSS JOIN {model}prior p JOIN {model}default d ON p.tag = d.tag
    LEFT JOIN (SELECT x.sid, x.tok_ix, l.tag, sum(l.logp - d.logp) AS gain
               FROM {pred} x JOIN {model}logp l ON x.key || '=' || x.value = l.feature
               JOIN {model}default d ON l.tag = d.tag GROUP BY ALL) g
      ON g.sid = b.sid AND g.tok_ix = b.tok_ix AND g.tag = p.tag)) WHERE r = 1"""


VIEWS["nbpred"] = _predict("predf", "nb")
VIEWS["halftagged"] = "SELECT * FROM tagged WHERE md5(sid) < '8'"
VIEWS["halftrainf"] = "SELECT * FROM trainf WHERE md5(sid) < '8'"
VIEWS["halfpredf"] = "SELECT * FROM predf WHERE md5(sid) >= '8'"
VIEWS.update(_nb("halftrainf", "hf", "halftagged"))
VIEWS["hfpred"] = _predict("halfpredf", "hf")
VIEWS["hflabel"] = "SELECT t.*, p.label FROM tok t JOIN hfpred p USING (sid, tok_ix) WHERE md5(t.sid) >= '8'"
VIEWS["halfgold"] = "SELECT * FROM goldkey WHERE md5(sid) >= '8'"
VIEWS["nblabel"] = 'SELECT t.*, p.label FROM tok t JOIN nbpred p USING (sid, tok_ix)'


def _decode(labels: str, drop: bool = True) -> str:
    keep = "AND coalesce(nxt, 'O') NOT LIKE 'B%'" if drop else ""
    return f"""
SELECT sid, min(start) AS start, max("end") AS "end", min(start) || '-' || max("end") AS "offset",
       string_agg(form, ' ' ORDER BY tok_ix) AS text, substr(arg_min(label, tok_ix), 3) AS type
FROM (SELECT *, first_value(nlab) OVER (PARTITION BY sid, grp ORDER BY tok_ix DESC) AS nxt FROM (
  SELECT *, lead(label) OVER (PARTITION BY sid ORDER BY tok_ix) AS nlab,
         sum(CASE WHEN label LIKE 'I%' THEN 0 ELSE 1 END) OVER (PARTITION BY sid ORDER BY tok_ix) AS grp
  FROM {labels}))
WHERE label <> 'O' {keep} GROUP BY sid, grp HAVING arg_min(label, tok_ix) LIKE 'B%'"""


VIEWS["decoded"] = _decode("guess")
VIEWS["decoded_all"] = _decode("guess", drop=False)
VIEWS["nbdecoded"] = _decode("nblabel")
VIEWS["hfdecoded"] = _decode("hflabel")


def _sets(view: str, key: str) -> str:
    return (
        f"SELECT 'CLASS' AS kind, {key} || '|' || type AS key FROM {view} UNION "
        f"SELECT 'NOCLASS', {key} FROM {view} UNION SELECT type, {key} FROM {view}"
    )


NER_KEY = "sid || '|' || \"offset\" || '|' || text"


def _stats(gold: str, pred: str, key: str = NER_KEY) -> str:
    return f"""
SELECT kind, tp, fp, fn, npred, nexp, round(p, 6) AS p, round(r, 6) AS r,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1, p AS p0, r AS r0,
       CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f0
FROM (SELECT *, CASE WHEN npred > 0 THEN tp / npred ELSE 0 END AS p, CASE WHEN nexp > 0 THEN tp / nexp ELSE 0 END AS r FROM (
  SELECT coalesce(g.kind, q.kind) AS kind, count(*) FILTER (g.key IS NOT NULL AND q.key IS NOT NULL) AS tp,
         count(*) FILTER (g.key IS NULL) AS fp, count(*) FILTER (q.key IS NULL) AS fn,
         count(q.key) AS npred, count(g.key) AS nexp
  FROM ({_sets(gold, key)}) g FULL OUTER JOIN ({_sets(pred, key)}) q ON g.kind = q.kind AND g.key = q.key
  GROUP BY 1)) WHERE nexp > 0 OR kind IN ('CLASS', 'NOCLASS')"""


MACRO = "SELECT round(avg(p0), 6) AS p, round(avg(r0), 6) AS r, round(avg(f0), 6) AS f1 FROM ({}) WHERE kind NOT IN ('CLASS', 'NOCLASS')"
STAT_COLUMNS = "kind, tp, fp, fn, npred, nexp, p, r, f1"

VIEWS["statg"] = _stats("goldkey", "decoded")
VIEWS["dist"] = "SELECT tag AS label, count(*) AS cnt FROM tagged GROUP BY tag"
VIEWS["weights"] = r"""
SELECT label, cnt, CASE WHEN label = 'O' THEN 1.0::DOUBLE WHEN label LIKE '%drug\_n%' ESCAPE '\' THEN most / cnt * 5
  WHEN cnt < most / 10 THEN most / cnt * 2 ELSE most / cnt END AS weight
FROM dist, (SELECT max(cnt)::DOUBLE AS most FROM dist WHERE label <> 'O')"""
VIEWS["words"] = "SELECT lower(form) AS word, count(*) AS n FROM tok GROUP BY 1"

# words against terms whose lengths can reach the cutoff, then the exact common-subsequence length
LCS = """list_last(list_reduce(string_split({a}, ''), lambda row, ch:
  list_reduce(range(1, len(row)), lambda cur, j: list_append(cur,
    CASE WHEN substr({b}, j, 1) = ch THEN row[j] + 1 ELSE greatest(row[j + 1], cur[j]) END), [0::BIGINT]), {zeros}))"""


# the byte form is made once per word, and words meet terms of one length class at a time
VIEWS["sized"] = """
SELECT word, length(word) AS la, @bytes(word) AS wb,
  unnest(range(ceil(length(word) * 85 / 115)::BIGINT, floor(length(word) * 115 / 85)::BIGINT + 1)) AS lb FROM words"""
VIEWS["terms"] = "SELECT term, type, length(term) AS lb, @bytes(term) AS tb FROM voc"
VIEWS["near"] = """
SELECT word, term, type FROM (
  SELECT word, term, type, la, w.lb FROM sized w JOIN terms t ON w.lb = t.lb WHERE 100 * levenshtein(wb, tb) <= 15 * (la + w.lb))
WHERE word = term OR 200 * @lcs(word, term) >= 85 * (la + lb)"""
VIEWS["alike"] = "SELECT DISTINCT word FROM near"
VIEWS["sim_approved"] = "SELECT DISTINCT word FROM near WHERE type <> 'drug_n'"
VIEWS["sim_other"] = "SELECT DISTINCT word FROM near WHERE type = 'drug_n'"

BINS = "list_transform(range(50), lambda i: 'emb_' || i || '=' || greatest(0, least(4, floor((vec[i + 1] + 1.0) * 2.5)))::INTEGER)"
VIEWS["bins"] = f"SELECT word, {BINS} AS b FROM vec"
VIEWS["full"] = (
    f"SELECT a.sid, a.tok_ix, a.tag, list_concat({_list(ALL + [chr(39) + 'pos=' + chr(39) + ' || coalesce(t.pos, ' + chr(39) + 'UNK' + chr(39) + ')'])}, "
    "coalesce(v.b, ['emb_OOV=true']), "
    "list_filter([CASE WHEN s1.word IS NOT NULL THEN 'fuzzyApprovedDrugsLexicon=true' END, "
    "CASE WHEN s2.word IS NOT NULL THEN 'fuzzyNotApprovedDrugsLexicon=true' END], lambda f: f IS NOT NULL)) AS f "
    "FROM around a LEFT JOIN (SELECT form AS tform, pos FROM tags) t ON a.form = tform LEFT JOIN bins v ON a.low = v.word "
    "LEFT JOIN sim_approved s1 ON a.low = s1.word LEFT JOIN sim_other s2 ON a.low = s2.word"
)

# features after J3's extraction: no lookup tables
VIEWS["plain"] = (
    f"SELECT sid, tok_ix, tag, {_list(ALL + [chr(39) + 'pos=UNK' + chr(39), chr(39) + 'emb_unavailable=true' + chr(39)])} AS f FROM around"
)
VIEWS["pltrainf"] = _one_hot("plain", "train")
VIEWS["plpredf"] = _one_hot("plain", "predict")
VIEWS.update(_nb("pltrainf", "pl"))
VIEWS["plpred"] = _predict("plpredf", "pl")
VIEWS["pllabel"] = 'SELECT t.*, p.label FROM tok t JOIN plpred p USING (sid, tok_ix)'
VIEWS["pldecoded"] = _decode("pllabel")

# features with the two term lists
VIEWS["listed"] = (
    "SELECT p.sid, p.tok_ix, p.tag, list_concat(p.f, list_filter([CASE WHEN s1.word IS NOT NULL THEN 'fuzzyApprovedDrugsLexicon=true' END, "
    "CASE WHEN s2.word IS NOT NULL THEN 'fuzzyNotApprovedDrugsLexicon=true' END], lambda f: f IS NOT NULL)) AS f "
    "FROM plain p JOIN shaped a USING (sid, tok_ix) LEFT JOIN sim_approved s1 ON a.low = s1.word LEFT JOIN sim_other s2 ON a.low = s2.word"
)
VIEWS["lxtrainf"] = _one_hot("listed", "train")
VIEWS["lxpredf"] = _one_hot("listed", "predict")

# ablations: the feature view without a group's keys
GROUPS = {
    "all": [],
    "no_lexicon": ["fuzzyApprovedDrugsLexicon", "fuzzyNotApprovedDrugsLexicon"],
    "no_context": [
        "formPrev", "formLowerPrev", "casingPrev", "bigram", "formPrev2", "trigram", "formNext", "formLowerNext",
        "casingNext", "formNext2", "suf3Prev", "suf3Next", "BoS", "EoS",
    ],
    "no_orthographic": [
        "wordShape", "casing", "hasDigit", "hasHyphen", "hasParenthesis", "hasBracket", "isLongWord",
    ],
    "no_suffix": ["suf3", "suf4", "suf5"],
}
for _name, _keys in GROUPS.items():
    _no = f" WHERE key NOT IN ({', '.join(repr(k) for k in _keys)})" if _keys else ""
    _p = f"ab_{_name}_"
    VIEWS[f"{_p}f"] = f"SELECT * FROM lxtrainf{_no}"
    VIEWS[f"{_p}q"] = f"SELECT * FROM lxpredf{_no}"
    VIEWS.update(_nb(f"{_p}f", _p))
    VIEWS[f"{_p}pred"] = _predict(f"{_p}q", _p)
    VIEWS[f"{_p}label"] = f"SELECT t.*, p.label FROM tok t JOIN {_p}pred p USING (sid, tok_ix)"
    VIEWS[f"{_p}decoded"] = _decode(f"{_p}label")

# chain model of log counts
VIEWS["chlong"] = "SELECT sid, tok_ix, tag, unnest(f) AS feature FROM chain"
VIEWS["chw"] = "SELECT feature, tag AS label, ln(count(*) + 1.0) AS weight FROM chlong GROUP BY ALL"
VIEWS["step"] = "SELECT a, b, ln(count(*) + 1.0) AS weight FROM (SELECT tag AS a, lead(tag) OVER (PARTITION BY sid ORDER BY tok_ix) AS b FROM tagged) WHERE b IS NOT NULL GROUP BY ALL"
VIEWS["labs"] = "SELECT DISTINCT tag AS label FROM tagged"
VIEWS["emit"] = """
SELECT t.sid, t.tok_ix, b.label, coalesce(e.s, 0) AS s FROM tok t CROSS JOIN labs b LEFT JOIN (
  SELECT c.sid, c.tok_ix, w.label, sum(w.weight) AS s FROM chlong c JOIN chw w USING (feature) GROUP BY ALL) e
ON e.sid = t.sid AND e.tok_ix = t.tok_ix AND e.label = b.label"""
VIEWS["moves"] = "SELECT x.label AS a, y.label AS b, coalesce(s.weight, 0) AS weight FROM labs x CROSS JOIN labs y LEFT JOIN step s ON s.a = x.label AND s.b = y.label"

VIEWS["overlap"] = """
SELECT g.sid, g.start AS gs, g."end" AS ge, g.type AS gt, q.start AS ps, q."end" AS pe, q.type AS pt,
  CASE WHEN g.start = q.start AND g."end" = q."end" AND g.type = q.type THEN 0
       WHEN g.start = q.start AND g."end" = q."end" THEN 1 ELSE 2 END AS rank
FROM goldkey g JOIN decoded q ON g.sid = q.sid AND g.start <= q."end" AND q.start <= g."end\""""

# Treebank words without look-around: a boundary is matched as the character beside it, and given back
W = r"[\p{L}\p{M}\p{N}_]"
EDGE = r"[^\p{L}\p{M}\p{N}_]"
LONE = r"('')([a-ce-lo-ru-zA-CE-LO-RU-Z0-9_\x{C0}-\x{24F}])($|" + EDGE + ")"
TREEBANK_BEFORE = [
    ("([«“‘„]|`+)", r" \1 "), ('^"', "``"), ("(``)", r" \1 "), (r"([ (\[{<])(?:\"|''{2})", r"\1 `` "), (LONE, r"\1 \2\3"), (LONE, r"\1 \2\3"),
    (r"([^.])(\.)([\])}>\"''»”’ ]*)\s*$", r"\1 \2 \3 "), (r"([:,])([^\p{Nd}])", r" \1 \2"), ("([:,])$", r" \1 "), (r"(\.{2,})", r" \1 "),
    ("([;@#$%&])", r" \1 "), ("([?!])", r" \1 "), ("([^''])'' ", r"\1 '' "), (r"(\*)", r" \1 "),
    (r"([\]\[(){}<>])", r" \1 "), ("(--)", r" \1 "),
]
TREEBANK_AFTER = [
    ("([»”’])", r" \1 "), ("('''')", r" \1 "), ('"', " '''' "), ("([^'' ])(''[sS]|''[mM]|''[dD]|'') ", r"\1 \2 "),
    ("([^'' ])(''ll|''LL|''re|''RE|''ve|''VE|n''t|N''T) ", r"\1 \2 "),
    *[(rf"(?i)({EDGE})({a})({b})({EDGE})", r"\1 \2 \3 \4") for _ in (1, 2) for a, b in (
        ("can", "not"), ("d", "''ye"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("more", "''n"))],
    (r"(?i)(" + EDGE + r")(wan)(na)(\s)", r"\1 \2 \3 \4"),
    *[(rf"(?i) (''t)({b})({EDGE})", r" \1 \2 \3") for b in ("is", "was")],
]


def _treebank(text: str) -> str:
    for pattern, by in TREEBANK_BEFORE:
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    text = f"(' ' || {text} || ' ')"
    for pattern, by in TREEBANK_AFTER:
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return text


VIEWS["bank"] = f"SELECT sid, text, list_filter(regexp_split_to_array({_treebank('text')}, '\\s+'), lambda w: w <> '') AS w FROM sent"
FOUND = "(CASE WHEN strpos(substr(text, a.nxt + 1), f) = 0 THEN -1 ELSE strpos(substr(text, a.nxt + 1), f) - 1 + a.nxt END)"
VIEWS["banktok"] = f"""
SELECT sid, unnest(range(len(done)))::INTEGER AS tok_ix, unnest(done) AS t FROM (
  SELECT sid, list_reduce(w, lambda a, f: {{'nxt': {FOUND} + length(f), 'done': list_append(a.done, {{'form': f, 'start': {FOUND}, 'end': {FOUND} + length(f) - 1}})}},
    {{'nxt': 0::BIGINT, 'done': []::STRUCT(form VARCHAR, start BIGINT, "end" BIGINT)[]}}).done AS done FROM bank)"""

# --- queries -----------------------------------------------------------------------------------

QUERIES = {
    "a1_read_annotated_xml": "SELECT sid, text, coalesce(e, 0)::INTEGER AS n_entities, coalesce(r, 0)::INTEGER AS n_pairs FROM sent "
    "LEFT JOIN (SELECT sid, count(*) AS e FROM ent GROUP BY sid) USING (sid) LEFT JOIN (SELECT sid, count(*) AS r FROM rel GROUP BY sid) USING (sid)",
    "a2_entity_segments": """
SELECT sid, ix AS ent_ix, 0 AS seg_ix, start, own_end AS "end", type FROM numbered
UNION ALL SELECT sid, ix, 1, nstart, "end", type FROM numbered WHERE nstart IS NOT NULL""",
    "a3_gold_entities": 'SELECT DISTINCT sid, "offset", text, type FROM ent',
    "a4_gold_relations": "SELECT DISTINCT sid, e1, e2, type FROM rel WHERE ddi",
    "a5_read_lexicon": r"SELECT DISTINCT lower(trim(line, ' ' || chr(9) || chr(10))) AS term FROM (SELECT unnest(string_split(text, '.')) AS line FROM benchmark) WHERE trim(line, ' ' || chr(9) || chr(10)) <> ''",
    "a6_read_embeddings": 'SELECT word, 50 AS dim, vec[1] AS "first", vec[50] AS "last" FROM vec',
    "a6_first_vectors": 'SELECT word, vec[1] AS "first" FROM (SELECT *, row_number() OVER (ORDER BY word) AS r FROM vec) WHERE r <= 150',
    "a7_write_features": "SELECT sid, md5(string_agg(sid || chr(9) || form || chr(9) || start || chr(9) || \"end\" || chr(9) || tag || chr(9) || array_to_string(f, chr(9)), chr(10) ORDER BY tok_ix)) AS digest FROM feats GROUP BY sid",
    "a8_read_features": "SELECT sid, tok_ix, form, start, \"end\", tag, md5(array_to_string(f, chr(9))) AS digest FROM feats",
    "a9_classification_rows": "SELECT tag, md5(array_to_string(f, chr(9))) AS digest, count(*) AS n FROM feats GROUP BY ALL",
    "a10_predictions": 'SELECT DISTINCT sid, "offset", text, type FROM decoded',
    "a11_model_round_trip": "SELECT feature, tag, round(logp, 6) AS logp, 'naive_bayes' AS kind FROM chlogp",
    "a11_crf_round_trip": "SELECT feature AS \"from\", label AS \"to\", round(weight, 6) AS weight, 'crf' AS kind FROM chw UNION ALL SELECT a, b, round(weight, 6), 'crf' FROM step",
    "a12_lexicon_from_drugbank": """
SELECT DISTINCT term FROM (
  SELECT p_name || ' ' || p_brand AS term FROM part WHERE p_size > 25 UNION
  SELECT upper(p_name) FROM part WHERE p_size > 25 UNION
  SELECT p_brand || ' ' || l_returnflag FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_size > 25)""",
    "a13_lexicon_from_chembl": """
SELECT md.p_partkey AS molregno, md.p_name AS pref_name, coalesce(string_agg(ms.l_returnflag, '; ' ORDER BY ms.l_returnflag), '') AS synonyms,
  (p_size % 5)::INTEGER AS approval_phase
FROM part md LEFT JOIN lineitem ms ON md.p_partkey = ms.l_partkey LEFT JOIN supplier di ON md.p_partkey = di.s_suppkey
LEFT JOIN nation mh ON md.p_partkey = mh.n_nationkey
WHERE md.p_size % 5 = 4 AND (di.s_nationkey IS NULL OR di.s_nationkey % 3 + 3 = 4)
  AND (mh.n_nationkey IS NULL OR md.p_partkey = CASE WHEN n_regionkey > 1 THEN n_nationkey ELSE -1 END)
GROUP BY ALL""",
    "a14_lexicon_from_annotations": 'SELECT type, lower(text) AS term, count(*) AS n FROM (SELECT DISTINCT sid, "offset", text, type FROM ent) GROUP BY ALL',
    "b1_tokenize": "SELECT sid, count(*)::INTEGER AS n, string_agg(form, ' ' ORDER BY tok_ix) AS forms FROM tok GROUP BY sid",
    "b1_tokenize_treebank": "SELECT sid, len(w)::INTEGER AS n, array_to_string(w, ' ') AS forms FROM bank",
    "b2_align_offsets_treebank": 'SELECT sid, tok_ix, t.form AS form, t.start::INTEGER AS start, t."end"::INTEGER AS "end" FROM banktok',
    "b2_align_offsets": "SELECT * FROM tok",
    "b3_bio_tag": "SELECT sid, string_agg(tag, ' ' ORDER BY tok_ix) AS tags FROM tagged GROUP BY sid",
    "b4_sanitize": r"""
SELECT sid, tok_ix, esc AS form, 'form=' || esc AS features FROM (
  SELECT sid, tok_ix, replace(replace(form, chr(10), '\n'), chr(9), '\t') AS esc FROM (
    SELECT page_id::VARCHAR AS sid, unnest(string_split(html, ' ')) AS form,
           unnest(range(len(string_split(html, ' '))))::INTEGER AS tok_ix FROM pages)) WHERE esc <> ''""",
    "c1_form": "SELECT form, lower(form) AS form_lower, n FROM forms",
    "c2_affixes": "SELECT form, n, " + ", ".join(f"{_affix(k, n)} AS {k}{n}" for n in (3, 4, 5) for k in ("pref", "suf")) + " FROM forms",
    "c3_char_bigrams": "SELECT form, n, concat_ws(' ', " + ", ".join(_gram(k) for k in range(5)) + ") AS grams FROM forms",
    "c4_word_shape": f"SELECT form, n, {_shape('form')} AS shape FROM forms",
    "c5_casing": "SELECT form, n, @casing(form) AS casing FROM forms",
    "c6_flags": "SELECT form, count(*) AS n, " + ", ".join(
        f"{cond} AS {name}" for name, cond in zip(("has_digit", "has_hyphen", "has_parenthesis", "has_bracket", "is_long"), FLAGS.values(), strict=True)
    ) + " FROM (SELECT unnest(string_split(text, ' ')) AS form FROM sent) GROUP BY form",
    "c7_patterns": r"""
SELECT form, n, CASE WHEN regexp_matches(form, '(?:^[a-z]+(?:ine|ion|ol)$)|(?:^\d+[A-Za-z])') THEN 'chemPattern=true' END AS chem,
  CASE WHEN starts_with(lower(form), 'anti') OR suffix(lower(form), 'ing') OR suffix(lower(form), 'tion') THEN 'drugAffix=true' END AS affix FROM forms""",
    "d1_previous": "SELECT sid, tok_ix, p1 AS form_prev, lp1 AS form_lower_prev, cp1 AS casing_prev, lp1 || '_' || low AS bigram FROM around",
    "d2_previous2": "SELECT sid, tok_ix, p2 AS form_prev2, lp2 || '_' || lp1 || '_' || low AS trigram FROM around",
    "d3_next": "SELECT sid, tok_ix, n1 AS form_next, ln1 AS form_lower_next, cn1 AS casing_next FROM around",
    "d4_next2": "SELECT sid, tok_ix, n2 AS form_next2 FROM around",
    "d5_boundaries": "SELECT sid, tok_ix, p1 IS NULL AS bos, n1 IS NULL AS eos FROM around WHERE p1 IS NULL OR n1 IS NULL",
    "e1_fuzzy_lexicon": "SELECT w.word, s.word IS NOT NULL AS similar, n FROM words w LEFT JOIN alike s ON w.word = s.word",
    "e2_exact_lexicon": """
SELECT word, l.term IS NOT NULL AS in_drug_lexicon, coalesce(l.type = 'brand', false) AS in_brand_list,
  coalesce(l.type = 'group', false) AS in_group_list, l.term IS NOT NULL OR x.term IS NOT NULL AS in_lexicon, n
FROM words w LEFT JOIN voc l ON w.word = l.term LEFT JOIN extern x ON w.word = x.term""",
    "e3_pos": "SELECT f.form, coalesce(t.pos, 'UNK') AS pos, n FROM forms f LEFT JOIN tags t ON f.form = t.form",
    "e3_fit_tagger": """
SELECT 'move' AS kind, before2 AS a, before AS b, tag, n FROM tagmoves
UNION ALL SELECT 'word', form, NULL, tag, n FROM tagwords
UNION ALL SELECT 'ending', ending, NULL, tag, n FROM tagends
UNION ALL SELECT 'order', k::VARCHAR, NULL, NULL, sum(n)::BIGINT FROM (
  SELECT n, CASE WHEN c3 >= c2 AND c3 >= c1 THEN 3 WHEN c2 >= c1 THEN 2 ELSE 1 END AS k FROM (
    SELECT n, CASE WHEN f12 > 1 THEN (n - 1) / (f12 - 1) ELSE 0 END AS c3, CASE WHEN f2 > 1 THEN (f23 - 1) / (f2 - 1) ELSE 0 END AS c2,
      CASE WHEN f > 1 THEN (f3 - 1) / (f - 1) ELSE 0 END AS c1 FROM (
      SELECT n, sum(n) OVER (PARTITION BY before2, before) AS f12, sum(n) OVER (PARTITION BY before, tag) AS f23,
        sum(n) OVER (PARTITION BY before) AS f2, sum(n) OVER (PARTITION BY tag) AS f3, sum(n) OVER () AS f FROM tagmoves))) GROUP BY k""",
    "e3_guess_tags": """
SELECT form, tag, round(sum(w * n / total), 6) AS share FROM (
  SELECT form, e.tag, e.n, s.total, CASE WHEN k = 0 THEN pow(x / (1 + x), most) ELSE pow(x, most - k) / pow(1 + x, most - k + 1) END AS w
  FROM (SELECT *, max(k) OVER (PARTITION BY form) AS most FROM (
      SELECT form, k, ending, total FROM (SELECT form, k, right(form, k) AS ending FROM (
        SELECT form, unnest(range(least(length(form), 10) + 1)) AS k FROM (
          SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS form FROM conversations)))
      JOIN (SELECT ending, sum(n) AS total FROM tagends GROUP BY ending) USING (ending))) s
  JOIN tagends e ON e.ending = s.ending,
    (SELECT coalesce(stddev_samp(p), 0) AS x FROM (SELECT count(*) / sum(count(*)) OVER () AS p FROM tagged GROUP BY tag))) GROUP BY form, tag""",
    "e4_embedding_bins": "SELECT w.word, array_to_string(coalesce(b.b, ['emb_OOV=true']), ' ') AS bins, n FROM words w LEFT JOIN bins b ON w.word = b.word",
    "e5_embedding_truncated": """
SELECT w.word, n, i::INTEGER AS i, round_even(vec[i + 1] * 10000, 0) / 10000 AS value FROM (
  SELECT w.word, n, vec, unnest(CASE WHEN vec IS NULL THEN [0] ELSE range(10) END) AS i FROM words w LEFT JOIN vec v ON w.word = v.word) w""",
    "e6_assemble": "SELECT sid, tok_ix, len(f)::INTEGER AS n, md5(array_to_string(f, chr(9))) AS digest FROM feats",
    "f1_boundary_rewrite": f"SELECT sid, tok_ix, md5(array_to_string({_rewritten('f')}, chr(9))) AS digest FROM feats",
    "f2_feature_map": "SELECT phase, key, count(*) AS n, count(DISTINCT value) AS n_values, sum(length(value))::BIGINT AS n_chars FROM (SELECT 'train' AS phase, key, value FROM trainf UNION ALL SELECT 'predict', key, value FROM predf) GROUP BY ALL",
    "f3_vocabulary": "SELECT key, count(*) AS n, sum(length(key) + 1 + length(value))::BIGINT AS n_chars FROM (SELECT DISTINCT key, value FROM trainf) GROUP BY key",
    "f4_fit_naive_bayes": """
SELECT tag, key, count(*) AS n, sum(round(logp * 1000000)::BIGINT)::BIGINT AS micro_logp FROM nblogp GROUP BY ALL
UNION ALL SELECT tag, 'PRIOR', 1, round(logp * 1000000)::BIGINT FROM nbprior
UNION ALL SELECT tag, 'DEFAULT', 1, round(logp * 1000000)::BIGINT FROM nbdefault""",
    "f5_predict_naive_bayes": "SELECT sid, tok_ix, label, score FROM nbpred",
    "g1_label_distribution": "SELECT label, cnt FROM dist",
    "g2_class_weights": "SELECT label, cnt, round(weight, 6) AS weight FROM weights",
    "g3_sequence_weights": "SELECT sid, round(coalesce(max(weight), 1.0), 6) AS weight FROM sent LEFT JOIN tagged USING (sid) LEFT JOIN weights ON tag = label GROUP BY sid",
    "g4_crf_gradient": """
SELECT 'attribute' AS kind, feature AS "from", tag AS "to", round(sum(count(*)) OVER (PARTITION BY feature) / k - count(*), 3) AS g
FROM chlong, (SELECT count(*) AS k FROM labs) GROUP BY feature, tag, k
UNION ALL SELECT 'transition', a, b, round(sum(count(*)) OVER () / (k * k) - count(*), 3) FROM (
  SELECT tag AS a, lead(tag) OVER (PARTITION BY sid ORDER BY tok_ix) AS b FROM tagged), (SELECT count(*) AS k FROM labs)
  WHERE b IS NOT NULL GROUP BY a, b, k
UNION ALL SELECT 'loss', NULL, NULL, round(count(*) * ln(any_value(k)), 3) FROM tagged, (SELECT count(*) AS k FROM labs)""",
    "g5_decode_crf": """
SELECT sid, count(*)::INTEGER AS n, round(any_value(best), 4) AS score,
  CASE WHEN max(near) = 1 THEN string_agg(label, ' ' ORDER BY tok_ix) END AS path FROM (
  SELECT sid, tok_ix, any_value(best) AS best, count(*) FILTER (s >= best - 0.0001) AS near, arg_max(label, s) AS label FROM (
    SELECT p.sid, p.tok_ix, p.label, p.s + b.s AS s, max(p.s + b.s) OVER (PARTITION BY p.sid) AS best
    FROM path p JOIN back b ON b.sid = p.sid AND b.tok_ix = p.tok_ix AND b.label = p.label) GROUP BY sid, tok_ix) GROUP BY sid""",
    "h1_bio_decode": 'SELECT sid, start, "end", text, type FROM decoded',
    "h1_bio_decode_keep_adjacent": 'SELECT sid, start, "end", text, type FROM decoded_all',
    "i1_instance_sets": _sets("goldkey", NER_KEY),
    "i2_statistics": f"SELECT {STAT_COLUMNS} FROM statg",
    "i3_macro_average": MACRO.format("SELECT * FROM statg"),
    "i4_micro_average": f"SELECT {STAT_COLUMNS} FROM statg WHERE kind IN ('CLASS', 'NOCLASS')",
    "i5_evaluate_relations": f"SELECT {STAT_COLUMNS} FROM (" + _stats("relgold", "relguess", "sid || '|' || e1 || '|' || e2") + ")",
    "i6_ablation": " UNION ALL ".join(
        f"SELECT '{name}' AS config, * FROM (" + MACRO.format(_stats("goldkey", f"ab_{name}_decoded")) + ")" for name in GROUPS
    ),
    "i7_error_analysis": """
SELECT outcome, gold_type, pred_type, count(*) AS n FROM (
  SELECT (['correct', 'type_confusion', 'boundary'])[rank + 1] AS outcome, gt AS gold_type, pt AS pred_type FROM (
    SELECT *, row_number() OVER (PARTITION BY sid, gs, ge, gt ORDER BY rank, ps, pe, pt) AS r FROM overlap) WHERE r = 1
  UNION ALL SELECT 'missed', type, NULL FROM goldkey g WHERE NOT EXISTS (
    SELECT 1 FROM overlap o WHERE o.sid = g.sid AND o.gs = g.start AND o.ge = g."end" AND o.gt = g.type)
  UNION ALL SELECT 'spurious', NULL, type FROM (SELECT DISTINCT sid, start, "end", type FROM decoded) q WHERE NOT EXISTS (
    SELECT 1 FROM overlap o WHERE o.sid = q.sid AND o.ps = q.start AND o.pe = q."end" AND o.pt = q.type)) GROUP BY ALL""",
    "j1_extract_features": "SELECT sid, tok_ix, tag, len(f)::INTEGER AS n, md5(array_to_string(f, chr(9))) AS digest FROM full_",
    "j2_train_and_score": f"SELECT {STAT_COLUMNS} FROM (" + _stats("halfgold", "hfdecoded") + ")",
    "j3_score_stream": 'SELECT sid, start, "end", text, type FROM pldecoded',
    "j3_score_stream_lookups": 'SELECT sid, start, "end", text, type FROM fldecoded',
}
VIEWS["full_"] = VIEWS.pop("full")
VIEWS["fltrainf"] = _one_hot("full_", "train")
VIEWS["flpredf"] = _one_hot("full_", "predict")
VIEWS.update(_nb("fltrainf", "fl"))
VIEWS["flpred"] = _predict("flpredf", "fl")
VIEWS["fllabel"] = 'SELECT t.*, p.label FROM tok t JOIN flpred p USING (sid, tok_ix)'
VIEWS["fldecoded"] = _decode("fllabel")
VIEWS["tagwords"] = "SELECT form, tag, count(*) AS n FROM tagged GROUP BY form, tag"
VIEWS["tagends"] = """
SELECT ending, tag, sum(n)::BIGINT AS n FROM (SELECT right(form, k) AS ending, tag, n FROM (
  SELECT form, tag, n, unnest(range(least(length(form), 10) + 1)) AS k FROM (
    SELECT *, sum(n) OVER (PARTITION BY form) AS seen FROM tagwords) WHERE seen <= 10)) GROUP BY ending, tag"""
VIEWS["tagmoves"] = """
SELECT before2, before, tag, count(*) AS n FROM (
  SELECT coalesce(lag(tag, 2) OVER w, '') AS before2, coalesce(lag(tag) OVER w, '') AS before, tag FROM (
    SELECT sid, tok_ix, tag FROM tagged UNION ALL SELECT sid, max(tok_ix) + 1, '' FROM tagged GROUP BY sid)
  WINDOW w AS (PARTITION BY sid ORDER BY tok_ix)) GROUP BY ALL"""
VIEWS["lastix"] = "SELECT sid, max(tok_ix) AS tok_ix FROM tok GROUP BY sid"
VIEWS["relgold"] = "SELECT DISTINCT sid, e1, e2, type FROM rel WHERE ddi"
VIEWS["relguess"] = "SELECT sid, e1, e2, CASE WHEN length(e2) % 4 = 0 THEN 'effect' ELSE type END AS type FROM relgold WHERE length(e1) % 3 <> 0"
VIEWS["path"] = """
SELECT sid, tok_ix, label, s FROM emit WHERE tok_ix = 0
UNION ALL
SELECT e.sid, e.tok_ix, e.label, e.s + m.s FROM (
  SELECT p.sid, p.tok_ix + 1 AS tok_ix, v.b AS label, max(p.s + v.weight) AS s
  FROM path p JOIN moves v ON v.a = p.label GROUP BY ALL) m
JOIN emit e ON e.sid = m.sid AND e.tok_ix = m.tok_ix AND e.label = m.label"""
VIEWS["back"] = """
SELECT e.sid, e.tok_ix, e.label, 0.0::DOUBLE AS s FROM emit e JOIN lastix USING (sid, tok_ix)
UNION ALL
SELECT m.sid, m.tok_ix, m.label, m.s FROM (
  SELECT p.sid, p.tok_ix - 1 AS tok_ix, v.a AS label, max(p.s + e.s + v.weight) AS s
  FROM back p JOIN emit e ON e.sid = p.sid AND e.tok_ix = p.tok_ix AND e.label = p.label JOIN moves v ON v.b = p.label
  WHERE p.tok_ix > 0 GROUP BY ALL) m"""
RECURSIVE = ("path", "back")
del VIEWS["stat_guess"]


def _lcs(match: re.Match) -> str:
    a, b = match.group(1), match.group(2)
    return LCS.format(a=a, b=b, zeros=f"list_transform(range(length({b}) + 1), lambda z: 0::BIGINT)")


def _expand(text: str) -> str:
    # levenshtein counts bytes here: one byte per character can only bring words closer together
    text = re.sub(r"@bytes\(([\w.]+)\)", r"regexp_replace(\1, '[^\\x00-\\x7f]', '?', 'g')", text)
    text = re.sub(r"@casing\((\w+)\)", lambda m: _casing(m.group(1)), text)
    return re.sub(r"@lcs\((\w+), (\w+)\)", _lcs, text)


def _statement(body: str) -> str:
    """Prepend the views a query uses, each after those it uses itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in order and re.search(rf"(?<![\w'.]){name}(?![\w'(])", text):
                if name in stack:
                    continue
                stack.append(name)
                visit(VIEWS[name])
                stack.pop()
                if name not in order:
                    order.append(name)

    stack: list[str] = []
    visit(body)
    views = ", ".join(f"{name} AS MATERIALIZED ({VIEWS[name].strip()})" for name in order if name not in RECURSIVE)
    steps = [name for name in RECURSIVE if name in order]
    views += "".join(f", {name} AS ({VIEWS[name].strip()})" for name in steps)
    recursive = "RECURSIVE " if steps else ""
    return _expand(f"WITH {recursive}{views} {body.strip()}" if order else body.strip())


def sql() -> dict[str, str]:
    return {name: _statement(body) for name, body in QUERIES.items()}
