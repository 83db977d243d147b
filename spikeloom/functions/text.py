"""Text columns (C13-C17): usernames, titles, bodies, hash filler, the rare viral post.

Every pick reads a few hex digits of a per-row md5 (no division, no Python), words come from
constant arrays, and sentences are slices of a constant word stream at per-row offsets.
All native and inside whole-stage codegen. Each function has a DuckDB twin (``*_sql``); twins
that write sentences need ``TEXT_CTE_SQL`` in the WITH list and ``TEXT_JOIN_SQL`` after FROM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikeloom.functions import words as W
from spikeloom.functions.draws import _c, digest, digest_sql, slice_uniform, slice_uniform_sql

V = len(W.VOCAB)
TWO32 = float(1 << 32)


# --- shared pieces ---------------------------------------------------------------------------

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _arr(ws) -> Column:
    """A constant string array: one literal split once at optimisation (constant folding), so
    the plan holds a single array value however long the list is."""
    assert not any("," in w for w in ws)
    return F.split(F.lit(",".join(ws)), ",")


def _arr_sql(ws) -> str:
    return "[" + ", ".join(_q(w) for w in ws) + "]"


def _hex(d: Column, start: int, n: int) -> Column:
    return F.conv(F.substring(d, start, n), 16, 10).cast("bigint")


def _hex_sql(d: str, start: int, n: int) -> str:
    return f"CAST(('0x' || substr({d}, {start}, {n})) AS BIGINT)"


def _pick(ws, idx0: Column) -> Column:
    return F.element_at(_arr(ws), (F.pmod(idx0, F.lit(len(ws))) + F.lit(1)).cast("int"))


def _pick_sql(ws, idx0: str) -> str:
    return f"({_arr_sql(ws)})[(({idx0}) % {len(ws)}) + 1]"


def _cap(s: Column) -> Column:
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30))


def _cap_sql(s: str) -> str:
    return f"(upper(substr({s}, 1, 1)) || substr({s}, 2))"


# Word stream: a constant array of BIG words built by a rule from VOCAB; a sentence is a slice of
# it at a per-row offset, so text needs no lambda (higher-order functions run interpreted and
# would re-hash per word) and stays inside whole-stage codegen.
BIG = 4096
_BIG_WORDS = tuple(W.VOCAB[(i * 37 + (i * i) % 89 * 11) % V] for i in range(BIG))
_BIG_CAPS = tuple(w.capitalize() for w in _BIG_WORDS)
# DuckDB builds the same arrays by the same rule, once, in a one-row CTE joined to the query
TEXT_CTE_SQL = (
    f"text_vocab AS (SELECT words, list_transform(words, lambda w: upper(substr(w, 1, 1)) || substr(w, 2)) AS caps "
    f"FROM (SELECT list_transform(range(0, {BIG}), lambda i: "
    f"({_arr_sql(W.VOCAB)})[((i * 37 + (i * i) % 89 * 11) % {V}) + 1]) AS words))")
TEXT_JOIN_SQL = "CROSS JOIN text_vocab"


def _start(h: Column, j: int) -> list[Column]:
    """Three places in the stream, from three 12-bit steps of the row's hash."""
    hj = h + F.lit(977 * j)
    return [F.pmod(F.shiftright(hj, 12 * i), F.lit(BIG - 16)) + F.lit(1) for i in range(3)]


def _start_sql(h: str, j: int) -> list[str]:
    return [f"((((({h}) + {977 * j}) >> {12 * i}) % {BIG - 16}) + 1)" for i in range(3)]


def _sentence(starts: list[Column], n: Column, end: str = ".") -> Column:
    """n >= 3 words from three places of the stream, a third from each (the rest from the last), first
    capitalised, then ``end``. Three places give about 7e10 different openings, so texts stay
    different as rows grow."""
    third = F.floor(n / F.lit(3)).cast("int")

    def words(i: int, skip: int, count: Column) -> Column:
        return F.slice(_arr(_BIG_WORDS), (starts[i] + skip).cast("int"), count.cast("int"))
    first = F.array(F.element_at(_arr(_BIG_CAPS), starts[0].cast("int")))
    all_words = F.concat(first, words(0, 1, third - 1), words(1, 0, third), words(2, 0, n - third * 2))
    return F.concat(F.array_join(all_words, " "), F.lit(end))


def _sentence_sql(starts: list[str], n: str, end: str = ".") -> str:
    third = f"(({n}) // 3)"
    a, b, c = starts
    return (f"(array_to_string([text_vocab.caps[{a}]] || list_slice(text_vocab.words, {a} + 1, {a} + {third} - 1) "
            f"|| list_slice(text_vocab.words, {b}, {b} + {third} - 1) "
            f"|| list_slice(text_vocab.words, {c}, {c} + ({n}) - 2 * {third} - 1), ' ') || {_q(end)})")


# --- C13 usernames ---------------------------------------------------------------------------

def make_username(seed: int, key) -> Column:
    """One of six patterns with equal odds: first_last, firstlast, first_last_##, hobby_first,
    first_##, realname (names are ours; hobby words and patterns are the source's)."""
    d = digest(seed, "username", key)
    pattern = F.floor(slice_uniform(d, 0) * F.lit(len(W.USERNAME_PATTERNS)))
    first = _pick(W.FIRST_NAMES, _hex(d, 13, 4))
    last = _pick(W.LAST_NAMES, _hex(d, 17, 4))
    hobby = _pick(W.HOBBIES, _hex(d, 21, 2))
    num = (F.pmod(_hex(d, 23, 4), F.lit(89)) + F.lit(10)).cast("string")
    u = F.lit("_")
    return (F.when(pattern == 0, F.concat(first, u, last))
            .when(pattern == 1, F.concat(first, last))
            .when(pattern == 2, F.concat(first, u, last, u, num))
            .when(pattern == 3, F.concat(hobby, u, first))
            .when(pattern == 4, F.concat(first, u, num))
            .otherwise(F.concat(first, last)))


def make_username_sql(seed: int, key: str) -> str:
    d = digest_sql(seed, "username", key)
    pattern = f"floor({slice_uniform_sql(d, 0)} * {len(W.USERNAME_PATTERNS)})"
    first = _pick_sql(W.FIRST_NAMES, _hex_sql(d, 13, 4))
    last = _pick_sql(W.LAST_NAMES, _hex_sql(d, 17, 4))
    hobby = _pick_sql(W.HOBBIES, _hex_sql(d, 21, 2))
    num = f"CAST(({_hex_sql(d, 23, 4)} % 89) + 10 AS VARCHAR)"
    return (f"(CASE WHEN {pattern} = 0 THEN {first} || '_' || {last} "
            f"WHEN {pattern} = 1 THEN {first} || {last} "
            f"WHEN {pattern} = 2 THEN {first} || '_' || {last} || '_' || {num} "
            f"WHEN {pattern} = 3 THEN {hobby} || '_' || {first} "
            f"WHEN {pattern} = 4 THEN {first} || '_' || {num} "
            f"ELSE {first} || {last} END)")


def make_user_handle(id_col, width: int = 8) -> Column:
    """Variant E's ``user_`` + zero-padded id."""
    return F.concat(F.lit("user_"), F.lpad(_c(id_col).cast("string"), width, "0"))


def make_user_handle_sql(id_col: str, width: int = 8) -> str:
    return f"('user_' || lpad(CAST({id_col} AS VARCHAR), {width}, '0'))"


# --- C14 titles ------------------------------------------------------------------------------

_TITLED = {
    "VERBS": tuple(w.capitalize() for w in W.VERBS),
    "ADJECTIVES": tuple(w.capitalize() for w in W.ADJECTIVES),
    "CONCEPTS": tuple(w.capitalize() for w in W.CONCEPTS),
}


def _title_fields(d: Column, d2: Column) -> dict:
    return {"kind": F.floor(slice_uniform(d, 0) * F.lit(len(W.POST_KINDS))),
            "a1": _hex(d, 13, 4), "a2": _hex(d, 17, 4), "c": _hex(d, 21, 4), "v": _hex(d, 25, 4),
            "col": _hex(d, 29, 2), "nn": _hex(d, 31, 2), "job": _hex(d2, 1, 4),
            "h": _hex(d2, 5, 12), "pn": _hex(d2, 29, 4)}


def _title_from(kind, a1, a2, c, v, col, nn, job, h, pn) -> Column:
    adj1, adj2 = _pick(W.ADJECTIVES, a1), _pick(W.ADJECTIVES, a2)
    concept, verb = _pick(W.CONCEPTS, c), _pick(W.VERBS, v)
    color, noun = _pick(W.COLORS, col), _pick(W.NOUNS, nn)
    job = _pick(W.JOBS, job)
    sp = F.lit(" ")
    catch = _cap(F.concat(adj1, sp, adj2, sp, concept))
    bs = F.concat(verb, sp, adj1, sp, concept)
    bs_title = F.concat(_pick(_TITLED["VERBS"], v), sp, _pick(_TITLED["ADJECTIVES"], a1), sp,
                        _pick(_TITLED["CONCEPTS"], c))
    plain_n = F.pmod(pn, F.lit(5)) + F.lit(3)
    st = _start(h, 0)
    return (F.when(kind == 2, F.concat(F.lit(W.TITLE_VIDEO), catch))
            .when(kind == 3, F.concat(F.lit(W.TITLE_PHOTO[0]), color, sp, noun, F.lit(W.TITLE_PHOTO[1])))
            .when(kind == 4, F.concat(F.lit(W.TITLE_LINK), bs_title))
            .when(kind == 5, F.concat(F.lit(W.TITLE_QUESTION[0]), _sentence(st, F.lit(6), W.TITLE_QUESTION[1])))
            .when(kind == 6, F.concat(F.lit(W.TITLE_ACHIEVEMENT[0]), job, F.lit(W.TITLE_ACHIEVEMENT[1])))
            .when(kind == 7, F.concat(F.lit(W.TITLE_OPINION[0]), bs, F.lit(W.TITLE_OPINION[1])))
            .when(kind == 8, F.concat(F.lit(W.TITLE_STORY), _sentence(st, F.lit(8))))
            .when(kind == 9, F.concat(F.lit(W.TITLE_MEME[0]), job, F.lit(W.TITLE_MEME[1]), color, sp, noun,
                                      F.lit(W.TITLE_MEME[2])))
            .otherwise(_sentence(st, plain_n)))


def make_title(seed: int, key) -> Column:
    """Ten post kinds with equal odds, each with its title template (`add_title` is the staged
    fast path)."""
    return _title_from(**_title_fields(digest(seed, "title", key), digest(seed, "title_words", key)))


def add_title(df: DataFrame, seed: int, key: str, out: str = "title") -> DataFrame:
    d1, d2 = f"__{out}_d1", f"__{out}_d2"
    df = df.withColumn(d1, digest(seed, "title", key)).withColumn(d2, digest(seed, "title_words", key))
    fields = _title_fields(F.col(d1), F.col(d2))
    df = df.select("*", *[c.alias(f"__{out}_{k}") for k, c in fields.items()])
    df = df.withColumn(out, _title_from(**{k: F.col(f"__{out}_{k}") for k in fields}))
    return df.drop(d1, d2, *[f"__{out}_{k}" for k in fields])


def make_title_sql(seed: int, key: str) -> str:
    d = digest_sql(seed, "title", key)
    d2 = digest_sql(seed, "title_words", key)
    kind = f"floor({slice_uniform_sql(d, 0)} * {len(W.POST_KINDS)})"
    adj1, adj2 = _pick_sql(W.ADJECTIVES, _hex_sql(d, 13, 4)), _pick_sql(W.ADJECTIVES, _hex_sql(d, 17, 4))
    concept, verb = _pick_sql(W.CONCEPTS, _hex_sql(d, 21, 4)), _pick_sql(W.VERBS, _hex_sql(d, 25, 4))
    color, noun = _pick_sql(W.COLORS, _hex_sql(d, 29, 2)), _pick_sql(W.NOUNS, _hex_sql(d, 31, 2))
    job = _pick_sql(W.JOBS, _hex_sql(d2, 1, 4))
    st = _start_sql(_hex_sql(d2, 5, 12), 0)
    catch = _cap_sql(f"({adj1} || ' ' || {adj2} || ' ' || {concept})")
    bs = f"({verb} || ' ' || {adj1} || ' ' || {concept})"
    bs_title = (f"({_pick_sql(_TITLED['VERBS'], _hex_sql(d, 25, 4))} || ' ' || "
                f"{_pick_sql(_TITLED['ADJECTIVES'], _hex_sql(d, 13, 4))} || ' ' || "
                f"{_pick_sql(_TITLED['CONCEPTS'], _hex_sql(d, 21, 4))})")
    plain_n = f"({_hex_sql(d2, 29, 4)} % 5 + 3)"
    return (f"(CASE WHEN {kind} = 2 THEN {_q(W.TITLE_VIDEO)} || {catch} "
            f"WHEN {kind} = 3 THEN {_q(W.TITLE_PHOTO[0])} || {color} || ' ' || {noun} || {_q(W.TITLE_PHOTO[1])} "
            f"WHEN {kind} = 4 THEN {_q(W.TITLE_LINK)} || {bs_title} "
            f"WHEN {kind} = 5 THEN {_q(W.TITLE_QUESTION[0])} || {_sentence_sql(st, '6', W.TITLE_QUESTION[1])} "
            f"WHEN {kind} = 6 THEN {_q(W.TITLE_ACHIEVEMENT[0])} || {job} || {_q(W.TITLE_ACHIEVEMENT[1])} "
            f"WHEN {kind} = 7 THEN {_q(W.TITLE_OPINION[0])} || {bs} || {_q(W.TITLE_OPINION[1])} "
            f"WHEN {kind} = 8 THEN {_q(W.TITLE_STORY)} || {_sentence_sql(st, '8')} "
            f"WHEN {kind} = 9 THEN {_q(W.TITLE_MEME[0])} || {job} || {_q(W.TITLE_MEME[1])} || {color} || ' ' || {noun} || {_q(W.TITLE_MEME[2])} "
            f"ELSE {_sentence_sql(st, plain_n)} END)")


# --- C15 bodies ------------------------------------------------------------------------------

MAX_SENTENCES = 7


def _body_fields(d: Column) -> dict:
    return {"u": slice_uniform(d, 0), "h": _hex(d, 13, 12), "x": _hex(d, 29, 4)}


def _body_from(u: Column, h: Column, x: Column) -> Column:
    short = u < F.lit(0.4)
    n_sent = (F.when(short, F.lit(1)).when(u < F.lit(0.8), F.lit(2) + F.pmod(x, F.lit(2)))
              .otherwise(F.lit(4) + F.pmod(x, F.lit(4))))
    parts = []
    for j in range(MAX_SENTENCES):
        n_other = F.lit(4) + F.pmod(x + F.lit(5 * j), F.lit(7))
        n = F.when(short, F.lit(5) + F.pmod(x, F.lit(10))).otherwise(n_other) if j == 0 else n_other
        sent = _sentence(_start(h, j), n)
        parts.append(sent if j == 0 else F.when(n_sent > F.lit(j), sent))
    return F.concat_ws(" ", *parts)


def make_body(seed: int, key) -> Column:
    """short 40 % (one sentence of 5..14 words), medium 40 % (2..3 sentences),
    long 20 % (4..7 sentences); paragraph sentences have 4..10 words.

    As one expression the digest is re-evaluated inside CASE branches; `add_body` stages it.
    """
    return _body_from(**_body_fields(digest(seed, "body", key)))


def add_body(df: DataFrame, seed: int, key: str, out: str = "body") -> DataFrame:
    """Fast path of `make_body`: digest, then its fields, then the text, as three projections
    (each later one reads the earlier columns several times, so Catalyst keeps them apart and
    every row hashes once)."""
    return _staged(df, digest(seed, "body", key), _body_fields, _body_from, out)


def _staged(df: DataFrame, d: Column, fields_fn, build_fn, out: str) -> DataFrame:
    dn = f"__{out}_d"
    df = df.withColumn(dn, d)
    fields = fields_fn(F.col(dn))
    df = df.select("*", *[c.alias(f"__{out}_{k}") for k, c in fields.items()])
    df = df.withColumn(out, build_fn(**{k: F.col(f"__{out}_{k}") for k in fields}))
    return df.drop(dn, *[f"__{out}_{k}" for k in fields])


def make_body_sql(seed: int, key: str) -> str:
    d = digest_sql(seed, "body", key)
    u = slice_uniform_sql(d, 0)
    h = _hex_sql(d, 13, 12)
    x = _hex_sql(d, 29, 4)
    short = f"({u} < 0.4)"
    n_sent = f"(CASE WHEN {short} THEN 1 WHEN {u} < 0.8 THEN 2 + {x} % 2 ELSE 4 + {x} % 4 END)"
    parts = []
    for j in range(MAX_SENTENCES):
        n_other = f"(4 + ({x} + {5 * j}) % 7)"
        n = f"(CASE WHEN {short} THEN 5 + {x} % 10 ELSE {n_other} END)" if j == 0 else n_other
        sent = _sentence_sql(_start_sql(h, j), n)
        parts.append(sent if j == 0 else f"(CASE WHEN {n_sent} > {j} THEN {sent} END)")
    return f"concat_ws(' ', {', '.join(parts)})"


# --- C16 variant E texts with the rare viral post --------------------------------------------

def viral_flag(seed: int, key, p: float = 0.001) -> Column:
    """True for the rare rows that carry the viral video (0.1 % by default)."""
    return slice_uniform(digest(seed, "viral", key), 0) < F.lit(p)


def viral_flag_sql(seed: int, key: str, p: float = 0.001) -> str:
    return f"({slice_uniform_sql(digest_sql(seed, 'viral', key), 0)} < {p!r})"


def make_title_e(seed: int, key) -> Column:
    d = digest(seed, "title_e", key)
    topic = F.floor(slice_uniform(d, 0) * F.lit(1000)).cast("bigint").cast("string")
    video = F.when(slice_uniform(d, 1) < F.lit(0.1), F.lit(W.E_TITLE_VIDEO)).otherwise(F.lit(""))
    return F.concat(F.lit(W.E_TITLE), topic, video)


def make_title_e_sql(seed: int, key: str) -> str:
    d = digest_sql(seed, "title_e", key)
    topic = f"CAST(CAST(floor({slice_uniform_sql(d, 0)} * 1000) AS BIGINT) AS VARCHAR)"
    video = f"(CASE WHEN {slice_uniform_sql(d, 1)} < 0.1 THEN {_q(W.E_TITLE_VIDEO)} ELSE '' END)"
    return f"({_q(W.E_TITLE)} || {topic} || {video})"


def make_body_e(seed: int, key, viral: Column) -> Column:
    d = digest(seed, "body_e", key)
    k_viral = (F.floor(slice_uniform(d, 0) * F.lit(5)) + F.lit(1)).cast("int")
    k_plain = (F.floor(slice_uniform(d, 0) * F.lit(4)) + F.lit(1)).cast("int")
    tag = F.when(slice_uniform(d, 1) < F.lit(0.3), F.lit(W.E_POST_TAG)).otherwise(F.lit(""))
    return F.when(viral, F.concat(F.lit(W.E_VIRAL_OPEN), F.repeat(F.lit(W.E_VIRAL_LINE), k_viral),
                                  F.lit(W.E_VIRAL_TAGS))) \
        .otherwise(F.concat(F.lit(W.E_POST_OPEN), _c(key).cast("string"), F.lit(": "),
                            F.repeat(F.lit(W.E_POST_LINE), k_plain), tag))


def make_body_e_sql(seed: int, key: str, viral: str) -> str:
    d = digest_sql(seed, "body_e", key)
    k_viral = f"CAST(floor({slice_uniform_sql(d, 0)} * 5) + 1 AS BIGINT)"
    k_plain = f"CAST(floor({slice_uniform_sql(d, 0)} * 4) + 1 AS BIGINT)"
    tag = f"(CASE WHEN {slice_uniform_sql(d, 1)} < 0.3 THEN {_q(W.E_POST_TAG)} ELSE '' END)"
    return (f"(CASE WHEN {viral} THEN {_q(W.E_VIRAL_OPEN)} || repeat({_q(W.E_VIRAL_LINE)}, {k_viral}) || "
            f"{_q(W.E_VIRAL_TAGS)} ELSE {_q(W.E_POST_OPEN)} || CAST({key} AS VARCHAR) || ': ' || "
            f"repeat({_q(W.E_POST_LINE)}, {k_plain}) || {tag} END)")


# --- C17 hash filler -------------------------------------------------------------------------

def _key(seed: int, tag: str, key) -> Column:
    return F.concat_ws("|", F.lit(str(seed)), F.lit(tag), _c(key).cast("string"))


def _key_sql(seed: int, tag: str, key: str) -> str:
    return f"concat_ws('|', '{seed}', '{tag}', CAST({key} AS VARCHAR))"


def hash_text(seed: int, tag: str, key, n: int) -> Column:
    """First n hex characters of sha-256 of the row key."""
    return F.substring(F.sha2(_key(seed, tag, key), 256), 1, n)


def hash_text_sql(seed: int, tag: str, key: str, n: int) -> str:
    return f"substr(sha256({_key_sql(seed, tag, key)}), 1, {n})"


def hash_username(seed: int, key) -> Column:
    """Variants B-C: 3 hex + '_' + 5 hex, with a two-digit suffix on 30 % of rows."""
    d = digest(seed, "hash_user", key)
    suffix = F.when(slice_uniform(d, 0) < F.lit(0.3),
                    (F.floor(slice_uniform(d, 1) * F.lit(90)) + F.lit(10)).cast("bigint").cast("string")
                    ).otherwise(F.lit(""))
    return F.lower(F.concat(hash_text(seed, "u1", key, 3), F.lit("_"), hash_text(seed, "u2", key, 5), suffix))


def hash_username_sql(seed: int, key: str) -> str:
    d = digest_sql(seed, "hash_user", key)
    suffix = (f"(CASE WHEN {slice_uniform_sql(d, 0)} < 0.3 THEN "
              f"CAST(CAST(floor({slice_uniform_sql(d, 1)} * 90) + 10 AS BIGINT) AS VARCHAR) ELSE '' END)")
    return (f"lower({hash_text_sql(seed, 'u1', key, 3)} || '_' || {hash_text_sql(seed, 'u2', key, 5)}"
            f" || {suffix})")
