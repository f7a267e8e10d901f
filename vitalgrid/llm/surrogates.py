"""Surrogates for personal data: keyed, of the same type and format, distinct, and the same for the same entity.

One pattern finds all kinds, left to right. An entity is a kind and a normal form
(digits of a phone number, lower-cased mail address), so its spellings share a
surrogate, which is written back in each spelling's format. A name is found by a title in front of it; each of
its words is an entity of its own with the title's gender, so a surname keeps its surrogate whether the
given name stands before it or not. Once a document has named a person, every mention of these words in it,
without a title too, is replaced; a title that tells no gender takes the one that the document gives
the word elsewhere.

Surrogates come from a keyed hash of the entity and an attempt number. An attempt is refused while its surrogate is taken by another
entity or equals an entity of the corpus; the refused take their next attempt, as often as it needs. Every
``GROW`` attempts a name gets another syllable, the local part of a mail address, a secret or a key another
letter, a phone number another digit, so that their surrogates are never used up. The other
kinds have a fixed length of at least nine digits (or four octets); only a corpus whose entities
fill half of such a kind is refused.

Everything is DataFrame functions. Defined cases: a null text stays null, an empty
one empty; rows with null or repeated doc_ids are treated by their own text;
equal rows give equal rows; extra columns pass through.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vitalgrid.llm.common import content_key, free_name, stored

GROW = 4
#: Rounds after which the kinds of fixed length are counted against their values.
COUNTED_ROUND = 64
FIXED_VALUES = {"ssn": 10**9, "ip": 254**4}

# Titles by the gender that they tell.
_MEN = "Mr|Sir|Lord|Herr|Herrn|Monsieur|Señor|Sr|Don|Господин|Κύριος"
_WOMEN = "Mrs|Ms|Miss|Lady|Dame|Frau|Fräulein|Mme|Mlle|Madame|Mademoiselle|Señora|Señorita|Sra|Srta|Doña|Dra|Doctora|Госпожа|Κυρία"
_ANYONE = "Mx|Dr|Doctor|Docteur|Prof|Professor|Rev|Reverend|Hon|Judge|Captain|Maître|Доктор"
_TITLES = f"{_MEN}|{_WOMEN}|{_ANYONE}"
_WORD = r"\p{Lu}(?:[\p{L}\p{M}]|-(?=\p{L})|['’](?=\p{Lu}))+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: kind -> pattern; the first that fits at a place counts.
PATTERNS = {
    "key_block": r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----",
    "secret": r"(?<![\p{L}\p{N}_])(?i:token|secret|password|passwd|pwd|api[_-]?key)(?-i)\s{0,3}[=:]\s{0,3}(?:\"[^\"\s]{6,}\"|'[^'\s]{6,}'|[^\s\"']{5,}[^\s\"'.,;:!?)\]}>])",
    "cloud_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,62})\.){1,8}\p{L}{2,24}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLES})\.? {_WORD}(?: {_WORD}){{0,2}}",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
_TITLE = rf"^((?:{_TITLES})\.? )"
_ASSIGN = r"^([\p{L}_-]+\s{0,3}[=:]\s{0,3}[\"']?)"
#: Syllables and endings of made-up names: script -> (syllables, men's endings, women's endings).
SYLLABLES = {
    "latin": ("ba be bo da de do fa fe ga ge ka ke la le lo ma me mi na ne no ra re ri sa se ta te va ve", "ron bert ric mund", "lina retta nia della"),
    "cyrillic": ("ба ве го да ки ла ле ма ми на ни ра ро са та", "мир слав рон", "мила рина лия"),
    "greek": ("βα γε δα κο λα λε μα με νι πα ρο σα τα", "νος δης ρος", "νη λια ρα"),
}


def may_hold(text: Column) -> Column:
    """False only for texts without any entity; cheaper than the pattern."""
    found = text.rlike("[0-9@=:]") | F.contains(text, F.lit("PRIVATE KEY"))
    for t in _TITLES.split("|"):
        found = found | F.contains(text, F.lit(t))
    return found


def _gender(head: Column) -> Column:
    return F.when(head.rlike(rf"^(?:{_WOMEN})\.? "), "f:").when(head.rlike(rf"^(?:{_MEN})\.? "), "m:").otherwise("n:")


def named_words(text: Column) -> Column:
    """(word, gender) of every titled name's words, lower-cased, in the order of the text."""

    def words(raw: Column) -> Column:
        return F.transform(F.split(F.regexp_replace(raw, _TITLE, ""), " "), lambda w: F.struct(w.alias("word"), _gender(raw).alias("gender")))

    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(PATTERNS["name"]), F.lit(0)), words))


def mention_pattern(named: Column) -> Column:
    """The pattern of a text with named words, NULL without them: also the words alone, as they are or in capitals."""
    words = F.transform(named, lambda n: n["word"])
    words = F.array_join(F.array_distinct(F.concat(words, F.transform(words, lambda w: F.upper(w)))), "|")
    around = r"|(?<![\p{L}\p{N}]|\p{L}['’-])(?=\p{Lu})(?:"
    return F.when(F.size(named) > 0, F.concat(F.lit(PATTERN + around), words, F.lit(r")(?![\p{L}\p{M}\p{N}]|['’-]\p{Lu})")))


def kind_of(raw: Column) -> Column:
    out = None
    for kind, p in PATTERNS.items():
        hit = raw.rlike(f"^(?:{p})$")
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("name")


def parts_of(raw: Column, kind: Column) -> tuple[Column, Column, Column]:
    """(what stays in front, the entity, what stays behind)."""
    head = F.when(kind == "secret", F.regexp_extract(raw, _ASSIGN, 1)).when(kind == "name", F.regexp_extract(raw, _TITLE, 1)).otherwise("")
    tail = F.when((kind == "secret") & raw.rlike("[\"']$"), F.right(raw, F.lit(1))).otherwise("")
    return head, F.substr(raw, F.char_length(head) + 1, F.char_length(raw) - F.char_length(head) - F.char_length(tail)), tail


def normal_form(core: Column, kind: Column, head: Column, named: Column) -> Column:
    """Equal for two spellings of one entity. A name's gender belongs to it: the title's, or what the text tells elsewhere."""
    known = F.filter(named, lambda n: (F.lower(n["word"]) == F.lower(core)) & (n["gender"] != "n:"))
    own = _gender(head)
    gender = F.when(own != "n:", own).otherwise(F.coalesce(F.get(known, F.lit(0))["gender"], F.lit("n:")))
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(core, r"\D", ""))
        .when(kind == "iban", F.regexp_replace(core, " ", ""))
        .when(kind == "email", F.lower(core))
        .when(kind == "name", F.concat(gender, F.lower(core)))
        .otherwise(core)
    )


def _draw(seed: Column, i, n: int) -> Column:
    """A number below n for place i, from the keyed seed."""
    return F.pmod(F.xxhash64(seed, i), F.lit(n)).cast("int")


def _drawn_chars(text: Column, seed: Column, fixed: Column, hexed: Column) -> Column:
    """Each digit or letter behind the first ``fixed`` characters replaced by one of its class."""

    def one(c: Column, i: Column) -> Column:
        def letter(alphabet: str) -> Column:
            return F.substr(F.lit(alphabet), _draw(seed, i, len(alphabet)) + 1, F.lit(1))

        return (
            F.when(i < fixed, c)
            .when(hexed & c.rlike("[0-9a-f]"), letter("0123456789abcdef"))
            .when(c.rlike("[0-9]"), letter("0123456789"))
            .when(c.rlike("[A-Z]"), letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"\p{IsCyrillic}"), letter("абвгдеиклмнопрст"))
            .when(c.rlike(r"\p{IsGreek}"), letter("αβγδεικλμνοπρστ"))
            .when(c.rlike(r"\p{L}"), letter("abcdefghijklmnopqrstuvwxyz"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """The check sum modulo 10 of a text of digits."""
    n = F.char_length(digits)

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((n - 1 - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), value), F.lit(0), lambda s, x: s + x) % 10


def _made_name(norm: Column, seed: Column, extra: Column) -> Column:
    words = F.split(F.substr(norm, F.lit(3), F.char_length(norm)), " ")

    def one(w: Column, i: Column) -> Column:
        out = None
        for script, (syllables, men, women) in SYLLABLES.items():
            s = F.array(*map(F.lit, syllables.split()))
            m, f = (F.array(*map(F.lit, x.split())) for x in (men, women))
            picks = [F.get(s, _draw(seed, F.lit(10) * i + k, len(syllables.split()))) for k in range(3)]
            more = F.transform(
                F.sequence(F.lit(1), extra), lambda j: F.get(s, _draw(seed, F.lit(1000) * (i + 1) + j, len(syllables.split())))
            )
            picks.append(F.when(extra > 0, F.array_join(more, "")).otherwise(""))
            her, his = F.get(f, _draw(seed, F.lit(10) * i + 7, len(women.split()))), F.get(m, _draw(seed, F.lit(10) * i + 7, len(men.split())))
            told = F.substr(norm, F.lit(1), F.lit(2))
            end = F.when((told == "f:") | ((told == "n:") & (_draw(seed, F.lit(10) * i + 8, 2) == 0)), her).otherwise(his)
            made = F.initcap(F.concat(*picks, end))
            if script == "latin":
                last = made
            else:
                hit = w.rlike(rf"\p{{Is{script.capitalize()}}}")
                out = F.when(hit, made) if out is None else out.when(hit, made)
        return out.otherwise(last)

    return F.array_join(F.transform(words, one), " ")


def surrogate_of(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The surrogate's normal form."""
    secret = F.lit(key)

    def seed(*what: Column) -> Column:
        inner = F.sha2(F.concat_ws("\x1f", secret, *what), 256)
        return F.sha2(F.concat(secret, inner), 256)  # keyed inside and outside

    own = seed(kind, norm, attempt.cast("string"))
    extra = F.floor(attempt / GROW).cast("int")
    letters = F.repeat(F.lit("a"), extra)  # drawn anew like the others
    longer = F.concat(norm, F.when(kind == "secret", letters).when(kind == "phone", F.repeat(F.lit("0"), extra)).otherwise(""))
    zero, no = F.lit(0), F.lit(False)
    domain = F.substring_index(norm, "@", -1)
    top = F.substring_index(domain, ".", -1)
    labels = F.substr(domain, F.lit(1), F.char_length(domain) - F.char_length(top))
    mail = F.concat(
        _drawn_chars(F.concat(F.substring_index(norm, "@", 1), letters), own, zero, no), F.lit("@"),
        _drawn_chars(labels, seed(F.lit("domain"), domain), zero, no), top,
    )
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_draw(own, i, 254) + 1).cast("string")), ".")
    card = _drawn_chars(norm, own, F.lit(1), no)
    body = F.substr(card, F.lit(1), F.char_length(card) - 1)
    check = ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string")
    card = F.when(_luhn(norm) == 0, F.concat(body, check)).otherwise(card)
    keeps = F.when(kind == "phone", F.greatest(F.char_length(norm) - 10, zero)).when(kind == "cloud_key", 4).when(kind == "iban", 2)
    keeps = keeps.when(kind == "key_block", F.instr(norm, "KEY-----") + 7).otherwise(0)
    return (
        F.when(kind == "email", mail).when(kind == "ip", octets).when(kind == "card", card)
        .when(kind == "name", F.concat(F.substr(norm, F.lit(1), F.lit(2)), F.lower(_made_name(norm, own, extra))))
        .when(kind == "key_block", _key_block(norm, own, keeps, letters))
        .otherwise(_drawn_chars(longer, own, keeps, (kind == "secret") & norm.rlike("^[0-9a-f]+$")))
    )


def _key_block(norm: Column, seed: Column, head: Column, letters: Column) -> Column:
    tail = F.substring_index(norm, "-----END", -1)
    body = F.substr(norm, head + 1, F.char_length(norm) - head - F.char_length(tail) - 8)
    return F.concat(F.substr(norm, F.lit(1), head), _drawn_chars(F.concat(body, letters), seed, F.lit(0), F.lit(False)), F.lit("-----END"), tail)


def written(core: Column, kind: Column, made: Column) -> Column:
    """The surrogate in the spelling's format."""

    def digits_of(pattern: str) -> Column:
        # Each character of the class takes the surrogate's next one.
        chars = F.split(core, "")
        nth = F.transform(chars, lambda c, i: F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x.rlike(pattern))))
        put = F.array_join(F.zip_with(chars, nth, lambda c, n: F.when(c.rlike(pattern), F.substr(made, n, F.lit(1))).otherwise(c)), "")
        return F.concat(put, F.substr(made, F.size(F.filter(chars, lambda x: x.rlike(pattern))) + 1, F.char_length(made)))

    cased = F.array_join(
        F.zip_with(F.split(core, ""), F.split(made, ""), lambda c, m: F.when((c != F.lower(c)) & m.isNotNull(), F.upper(m)).otherwise(m)), ""
    )
    bare = F.substr(made, F.lit(3), F.char_length(made))
    name = F.when((core == F.upper(core)) & (F.char_length(core) > 1), F.upper(bare)).otherwise(F.initcap(bare))
    return (
        F.when(kind.isin("phone", "card", "ssn"), digits_of("[0-9]")).when(kind == "iban", digits_of("[A-Z0-9]"))
        .when(kind == "email", F.when(F.char_length(core) == F.char_length(made), cased).otherwise(made)).when(kind == "name", name)
        .otherwise(made)
    )


def find_entities(docs: DataFrame) -> DataFrame:
    """(doc_id, content, pattern, pos, part, head, core, tail, kind, norm): every entity of every text.

    A name gives a row per word, with the title or the blank before it as its head. ``pattern`` is the text's own where it names someone.
    """
    text = F.col("text")
    rows = docs.where(may_hold(text)).select("doc_id", content_key(text).alias("content"), "text", named_words(text).alias("named"))
    rows = rows.withColumn("pattern", mention_pattern(F.col("named")))
    plain = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    own = F.regexp_extract_all(text, F.col("pattern"), F.lit(0))
    found = rows.select("doc_id", "content", "named", "pattern", F.posexplode(F.when(F.col("pattern").isNull(), plain).otherwise(own)).alias("pos", "raw"))
    found = found.withColumn("kind", kind_of(F.col("raw")))
    head, core, tail = parts_of(F.col("raw"), F.col("kind"))
    found = found.select("doc_id", "content", "named", "pattern", "pos", "kind", head.alias("head"), core.alias("core"), tail.alias("tail"))
    words = F.when(F.col("kind") == "name", F.split("core", " ")).otherwise(F.array("core"))
    found = found.withColumn("title", F.col("head")).select("*", F.posexplode(words).alias("part", "word")).drop("core")
    found = found.withColumn("norm", normal_form(F.col("word"), F.col("kind"), F.col("title"), F.col("named")))
    head = F.when(F.col("part") > 0, " ").otherwise(F.col("head")).alias("head")
    return found.select("doc_id", "content", "pattern", "pos", "part", head, F.col("word").alias("core"), "tail", "kind", "norm")


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, made) for the distinct entities, without two alike and without a real one."""
    made = surrogate_of(F.col("kind"), F.col("norm"), F.col("attempt"), key).alias("made")
    # Dealt by number: drawing is work for the processor, whatever the bytes.
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = entities.select("kind", "norm").repartition(tasks, "kind", "norm").distinct()
    now = stored(distinct.withColumn("attempt", F.lit(0)).select("*", made))
    for i in itertools.count(1):
        real = now.select(F.col("kind").alias("_k"), F.col("norm").alias("_n"))
        nth = F.row_number().over(W.partitionBy("kind", "made").orderBy("attempt", "norm"))
        checked = now.withColumn("nth", nth).join(real, (F.col("kind") == F.col("_k")) & (F.col("made") == F.col("_n")), "left")
        checked = stored(checked.select("kind", "norm", "attempt", "made", ((F.col("nth") > 1) | F.col("_n").isNotNull()).alias("bad")))
        if checked.where("bad").isEmpty():
            return checked.select("kind", "norm", "made")
        if i == COUNTED_ROUND:
            for r in checked.groupBy("kind").count().collect():  # a row per kind
                if 2 * r["count"] > FIXED_VALUES.get(r["kind"], math.inf):
                    raise ValueError(f"{r['count']} entities of kind {r['kind']} fill half of its format: too few surrogates are left")
        again = checked.where("bad").select("kind", "norm", (F.col("attempt") + 1).alias("attempt")).select("*", made)
        now = stored(checked.where("not bad").select("kind", "norm", "attempt", "made").union(again))


def replace_entities(docs: DataFrame, key: str, n_entities: str | None = None) -> DataFrame:
    """``docs`` with surrogates in the text; the count of entities replaces a column of its name."""
    found = stored(find_entities(docs))
    made = assign(found, key)
    new = F.concat("head", written(F.col("core"), F.col("kind"), F.col("made")), "tail")
    texts = found.join(made, ["kind", "norm"]).select("doc_id", "content", "pattern", "pos", F.struct("part", new.alias("new")).alias("x"))
    # Equal rows of one document give equal parts once.
    whole = F.array_join(F.transform(F.array_sort(F.collect_set("x")), lambda x: x["new"]), "")
    texts = texts.groupBy("doc_id", "content", "pattern", "pos").agg(whole.alias("new"))
    lists = texts.groupBy("doc_id", "content").agg(F.array_sort(F.collect_list(F.struct("pos", "new"))).alias("x"), F.max("pattern").alias("pattern"))
    mark, doc, own, new, pattern = (free_name(docs, f"_{n}") for n in ("content", "doc", "own", "new", "pattern"))
    lists = lists.select(F.col("doc_id").alias(doc), F.col("content").alias(own), F.col("x.new").alias(new), F.col("pattern").alias(pattern))
    rows = docs.withColumn(mark, content_key(F.col("text")))
    rows = rows.join(lists, rows["doc_id"].eqNullSafe(lists[doc]) & (rows[mark] == lists[own]), "left")
    between = F.when(F.col(pattern).isNull(), F.split("text", PATTERN, -1)).otherwise(F.split("text", F.col(pattern), -1))
    pieces = F.flatten(F.zip_with(between, F.col(new), lambda a, b: F.array(a, F.coalesce(b, F.lit("")))))
    text = F.when(F.col(new).isNull(), F.col("text")).otherwise(F.array_join(pieces, "")).alias("text")
    extra = [F.coalesce(F.size(new), F.lit(0)).cast("long").alias(n_entities)] if n_entities else []
    stay = [c for c in docs.columns if c.lower() != (n_entities or "").lower()]
    return rows.select(*[text if c.lower() == "text" else docs[c] for c in stay], *extra)
