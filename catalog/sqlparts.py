"""Pieces the checking SQL shares: tokens, derived graphs, unrolled rounds."""

TOKEN = r"[\p{L}\p{N}_][\p{L}\p{N}\p{M}_]*(?:[''’.][\p{L}\p{N}_][\p{L}\p{N}\p{M}_]*)*"
STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def strip(expr: str) -> str:
    return STRIP.format(expr)


def term(token: str) -> str:
    """Apostrophe cut, folding, lower case."""
    out = f"strip_accents(regexp_replace({token}, '[''’].*$', ''))"
    for letter, plain in {"ß": "ss", "æ": "ae", "œ": "oe", "Æ": "AE", "Œ": "OE", "ø": "o", "Ø": "O"}.items():
        out = f"replace({out}, '{letter}', '{plain}')"
    return f"lower({out})"


def tokens(table: str = "documents", key: str = "doc_id") -> str:
    return (f"select {key} as doc_id, generate_subscripts(t, 1) - 1 as pos, unnest(t) as token from "
            f"(select {key}, regexp_extract_all(text, '{TOKEN}') as t from {table})")


def terms(table: str = "documents", key: str = "doc_id") -> str:
    return f"select doc_id, pos, {term('token')} as term from ({tokens(table, key)})"


def pairs(suppliers: bool = False) -> str:
    more = " union all select l_partkey, -l_suppkey from lineitem" if suppliers else ""
    return ("select * from (select l_partkey as src, lead(l_partkey) over (partition by l_orderkey "
            f"order by l_linenumber, l_partkey) as dst from lineitem) where dst is not null{more}")


def edges(suppliers: bool = False) -> str:
    return f"select distinct src, dst from ({pairs(suppliers)})"


def vertices(suppliers: bool = False) -> str:
    return f"select src as id from ({edges(suppliers)}) union select dst from ({edges(suppliers)})"


def chain(k: int) -> str:
    return (f"select o_orderkey + 1 as src, case when (o_orderkey + 1) % {k} = 0 or o_orderkey = (select max(o_orderkey) from orders) "
            "then 0 else o_orderkey + 2 end as dst from orders")


def rank_rounds(edge_sql: str, vertex_sql: str, rounds: int, precision: float | None = None) -> str:
    """CTEs ``e, v, o, n, r0 … rN``; ``r{rounds}`` has ``id, r``."""
    mass = "coalesce(sum(r), 0)"
    if precision:
        units = f"{round(1 / precision)}::double"
        mass = f"floor({mass} * {units}) / {units}"
    parts = [
        f"e as materialized ({edge_sql})", f"v as materialized ({vertex_sql})",
        "o as materialized (select src, count(*) as od from e group by src)",
        "n as materialized (select count(*)::double as n from v)",
        "r0 as materialized (select id, 1 / n as r from v, n)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"r{i} as materialized (select v.id, (1 - 0.85::double) / n + 0.85::double * m / n + 0.85::double * coalesce(s, 0) as r "
            f"from v cross join n cross join (select {mass} as m from r{i - 1} where id not in (select src from o)) "
            f"left join (select e.dst, sum(p.r / o.od) as s from e join o on o.src = e.src "
            f"join r{i - 1} p on p.id = e.src group by e.dst) g on g.dst = v.id)")
    return "with " + ", ".join(parts)


def hits_rounds(edge_sql: str, vertex_sql: str, rounds: int, l2: bool) -> str:
    """CTEs ``e, v, h0 … hN``; ``h{rounds}`` has ``id, hub, authority``."""
    scale = "sqrt(sum({0} * {0}))" if l2 else "sum({0} * {0})"
    parts = [f"e as materialized ({edge_sql})", f"v as materialized ({vertex_sql})",
             "h0 as materialized (select id, 1::double as hub, 1::double as authority from v)"]
    for i in range(1, rounds + 1):
        parts.append(
            f"w{i} as materialized (select v.id, coalesce(a.s, 0) as hub, coalesce(b.s, 0) as authority from v "
            f"left join (select e.src, sum(p.authority) as s from e join h{i - 1} p on p.id = e.dst group by e.src) a on a.src = v.id "
            f"left join (select e.dst, sum(p.hub) as s from e join h{i - 1} p on p.id = e.src group by e.dst) b on b.dst = v.id)")
        parts.append(
            f"h{i} as materialized (select id, hub / (select {scale.format('hub')} from w{i}) as hub, "
            f"authority / (select {scale.format('authority')} from w{i}) as authority from w{i})")
    return "with " + ", ".join(parts)


def base_rounds(edge_sql: str, root_sql: str, rounds: int, sample: int) -> str:
    """CTEs ``e, b0 … bN``; ``b{rounds}`` has ``id``."""
    parts = [f"e as materialized ({edge_sql})", f"b0 as materialized ({root_sql})"]
    for i in range(1, rounds + 1):
        parts.append(f"c{i} as materialized (select id from b{i - 1} union select dst from e where src in (select id from b{i - 1}))")
        parts.append(
            f"b{i} as materialized (select id from c{i} union all select * from (select distinct src as id from e "
            f"where dst in (select id from c{i}) and src not in (select id from c{i}) order by md5(id::varchar), id limit {sample}))")
    return "with " + ", ".join(parts)


def bm25(query: list[str], terms_sql: str | None = None) -> str:
    """CTEs up to ``scored`` with ``doc_id, score``, over the terms of the texts or those given."""
    words = ", ".join(f"'{w}'" for w in query)
    return (
        f"with t as materialized ({terms_sql or terms()}), d as materialized (select doc_id, count(*) as len from t group by doc_id), "
        "c as (select (select count(*) from documents)::double as n, (select count(*) from t)::double / (select count(*) from documents) as avglen), "
        f"p as materialized (select doc_id, term, count(*)::double as tf from t where term in ({words}) group by doc_id, term), "
        "f as materialized (select term, count(*)::double as df from p group by term), "
        "scored as materialized (select p.doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2::double * (1 - 0.75::double + 0.75::double * len / avglen))) as score "
        "from p join f using (term) join d using (doc_id) cross join c group by p.doc_id)")


def highlighted(text: str, words: list[str], fragments: int | None = 5) -> str:
    """Sentences with a marked word. The query's words are plain ASCII, so case is all that varies."""
    inner = text
    for _ in range(2):  # a letter ends one match and cannot begin the next
        inner = rf"regexp_replace({inner}, '([\p{{L}}\p{{N}}\p{{M}}_])\.([\p{{L}}\p{{N}}_])', '\1' || chr(5) || '\2', 'g')"
    sentences = rf"regexp_extract_all({inner}, '[^.!?\n]+[.!?]*')"
    cut = rf"regexp_replace(replace(s, chr(5), '.'), '({TOKEN})', chr(3) || '\1' || chr(4), 'g')"
    hit = rf"regexp_replace({cut}, '(?i)' || chr(3) || '({'|'.join(words)})' || chr(4), chr(1) || '\1' || chr(2), 'g')"
    marked = f"list_transform({sentences}, lambda s: replace(replace({hit}, chr(3), ''), chr(4), ''))"
    some = f"[1:{fragments}]" if fragments else ""
    chosen = f"list_transform(list_filter({marked}, lambda s: contains(s, chr(1))){some}, lambda s: trim(s, ' '))"
    joined = f"coalesce(array_to_string({chosen}, ' … '), '')"
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        joined = f"replace({joined}, '{sign}', '{name}')"
    return f"replace(replace({joined}, chr(1), '<em>'), chr(2), '</em>')"


def stems(vocabulary_sql: str) -> str:
    """The stemming rules as pattern replacements, ``term, stem, cf``."""
    c, v = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
    m0, m1 = f"^({c})?{v}{c}", f"^({c})?{v}{c}{v}{c}"
    one = f"^({c})?{v}{c}({v})?$"
    vowel = f"^({c})?[aeiouy]"
    cvc = f"^{c}[aeiouy][^aeiouwxy]$"

    def cut(n: int) -> str:
        return f"left(w, length(w) - {n})"

    def has(pattern: str, expr: str) -> str:
        return f"regexp_matches({expr}, '{pattern}')"

    def table(rows: list[tuple[str, str]], pattern: str) -> str:
        cases = " ".join(
            f"when w like '%{s}' then case when {has(pattern, cut(len(s)))} then {cut(len(s))} || '{r}' else w end"
            for s, r in sorted(rows, key=lambda x: -len(x[0])))
        return f"case {cases} else w end"

    two = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
           ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
           ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
           ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log")]
    three = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
    four = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti",
            "ous", "ive", "ize", "ion"]
    last = " ".join(
        f"when w like '%{s}' then case when {has(m1, cut(len(s)))}"
        + (f" and {has('[st]$', cut(3))}" if s == "ion" else "") + f" then {cut(len(s))} else w end"
        for s in sorted(four, key=lambda x: -len(x)))
    steps = [
        f"case when w like '%sses' or w like '%ies' then {cut(2)} when w like '%s' and w not like '%ss' then {cut(1)} else w end",
        # a tilde marks words that lost -ed or -ing and need the clean-up below; a first y is a consonant, kept apart as Y
        f"case when w like '%eed' then case when {has(m0, cut(3))} then {cut(1)} else w end "
        f"when w like '%ed' then case when {has(vowel, cut(2))} then {cut(2)} || '~' else w end "
        f"when w like '%ing' then case when {has(vowel, cut(3))} then {cut(3)} || '~' else w end else w end",
        f"case when w not like '%~' then w when {has('(at|bl|iz)~$', 'w')} then replace(w, '~', 'e') "
        f"when {has('(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)~$', 'w')} then {cut(2)} "
        f"when {has(one, cut(1))} and {has(cvc, cut(1))} then replace(w, '~', 'e') else {cut(1)} end",
        f"case when w like '%y' and {has(vowel, cut(1))} then {cut(1)} || 'i' else w end",
        table(two, m0), table(three, m0), f"case {last} else w end",
        f"case when w like '%e' and ({has(m1, cut(1))} or ({has(one, cut(1))} and not {has(cvc, cut(1))})) then {cut(1)} else w end",
        f"case when w like '%ll' and {has(m1, 'w')} then {cut(1)} else w end",
    ]
    sql = f"select term, cf, regexp_replace(term, '^y', 'Y') as w from ({vocabulary_sql})"
    for step in steps:
        sql = f"select term, cf, case when length(term) < 3 then w else {step} end as w from ({sql})"
    return f"select term, lower(w) as stem, cf from ({sql})"
