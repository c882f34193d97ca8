"""Text cleaning, tokens and sentences as Column expressions; all but the sentences' spans stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions import scan

#: Token pattern, fixed: a run of ASCII letters and digits, or any other single character.
PIECE = r"[0-9a-zA-Z]+|[^0-9a-zA-Z]"
#: Unicode blanks and private-use characters that count as blanks, fixed values.
BLANKS = "\u2028\u2029\u200a\u2009\u2008\u2005\u2004\u2003\u2002\u00a0\uf8ff\u202f\ufeff\uf044\uf02d\uf0bb\uf048\uf0b0"
#: ASCII punctuation as a regular-expression class body.
PUNCTUATION = r"!-/:-@\[-`{-~"
_MARK = "\u0001"


def _as(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, f) -> Column:
    """``f`` of a value that is computed once: inside a lambda a plain expression would be computed each time."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def clean_input(c: Column | str) -> Column:
    """Line ends, tabs and no-break blanks to blanks, ``|`` to ``/``, other than ASCII dropped."""
    flat = F.regexp_replace(_as(c), "\r\n", " ")
    flat = F.replace(F.regexp_replace(flat, "[\n\t\u00a0\u000b\u000c]", " "), F.lit("|"), F.lit("/"))
    return F.regexp_replace(flat, r"[^\x00-\x7F]", "")


def cut_long_words(c: Column | str, most: int = 50) -> Column:
    """Tokens over ``most`` characters cut, and then all tokens joined by blanks; other texts as they are."""
    toks = tokens(c)
    cut = F.array_join(F.transform(toks, lambda t: F.substring(t, 1, most)), " ")
    return F.when(F.exists(toks, lambda t: F.length(t) > most), cut).otherwise(_as(c))


def normalise_blanks(c: Column | str) -> Column:
    """Unicode blanks and private-use marks to plain blanks."""
    return F.translate(F.regexp_replace(_as(c), "\r ", " "), BLANKS, " " * len(BLANKS))


def normalise_marks(c: Column | str) -> Column:
    """Like normalise_blanks, but two private-use marks become the letter and the sign they stand for."""
    return normalise_blanks(F.translate(_as(c), "\uf048\uf0b0", "\u0397\u00b0"))


def pieces(c: Column | str) -> Column:
    """All tokens, blanks too: joined they are the text."""
    return F.regexp_extract_all(_as(c), F.lit(f"({PIECE})"), 0)


def tokens(c: Column | str) -> Column:
    return F.filter(pieces(c), lambda t: t != " ")


def display_token(t: Column, most: int = 20, kept: int = 10) -> Column:
    """What a tagger sees of a long token."""
    return F.when(F.length(t) > most, F.substring(t, 1, kept)).otherwise(t)


def running_starts(lengths: Column, deep: int = 3) -> Column:
    """The sum of what comes before each number of an array: in blocks of 32, whose sums are added up the same way."""
    nothing = F.array(F.lit(0)).cast("array<int>")

    def run(block: Column, base: Column) -> Column:
        """The sums before each number of a short array, and the sum of all."""
        return F.aggregate(block, F.array(base), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def sums(n: Column) -> Column:
        if not deep:
            return F.slice(run(n, F.lit(0)), 1, F.size(n))
        blocks = F.sequence(F.lit(0), F.floor((F.size(n) - 1) / 32).cast("int"))
        part = lambda b: F.slice(n, b * 32 + 1, 32)
        heads = running_starts(F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(0), lambda a, x: a + x)), deep - 1)
        return let(heads, lambda h: F.flatten(F.transform(blocks, lambda b: let(
            part(b), lambda p: F.slice(run(p, F.get(h, b)), 1, F.size(p))
        ))))

    return F.when(F.size(lengths) == 0, F.slice(nothing, 1, 0)).otherwise(let(lengths, sums))


def _spans(parts: Column, base: Column) -> Column:
    """tok, start and end (inclusive) of consecutive parts of a text."""
    def build(p: Column) -> Column:
        at = running_starts(F.transform(p, F.length))
        return F.zip_with(
            p, at, lambda t, s: F.struct(t.alias("tok"), (base + s).alias("start"), (base + s + F.length(t) - 1).alias("end"))
        )

    return let(parts, build)


def token_spans(sentence: Column | str, start: Column | int = 0) -> Column:
    """tok, start and end (inclusive) of a sentence's tokens; ``start`` is the sentence's own."""
    base = start if isinstance(start, Column) else F.lit(start)
    return F.filter(_spans(pieces(sentence), base), lambda x: x["tok"] != " ")


def split_sentences(c: Column | str, merge_lower: bool = False) -> Column:
    """Sentences whose concatenation is the text.

    One ends after ``?`` or ``!``, and after ``.`` before a blank and a capital, hyphen or
    quote, unless at most one character follows. With ``merge_lower`` a sentence that begins in
    lower case (after blanks) goes on with the one before.
    """
    stop = r"([?!])(?=..)(?!\s*[a-z])" if merge_lower else r"([?!])(?=..)"
    marked = F.regexp_replace(_as(c), f"(?s){stop}", f"$1{_MARK}")
    marked = F.regexp_replace(marked, r"\.(?= [A-Z\-\"'])", f".{_MARK}")
    return F.split(marked, _MARK)


def cut_sentence(sentence: Column, most: int = 100, piece: int = 200) -> Column:
    """A sentence over ``most`` tokens as pieces of ``piece`` raw tokens, cut on while the rest has ``most`` or more.

    A blank rest is dropped; a shorter sentence stays whole.
    """
    def cut(raw: Column) -> Column:
        solid = F.transform(raw, lambda t: (t != " ").cast("int"))
        n = F.ceil(F.size(raw) / F.lit(piece)).cast("int")
        left = lambda i: F.aggregate(F.slice(solid, i * piece + 1, F.size(raw)), F.lit(0), lambda a, x: a + x)
        part = lambda a, size: F.array_join(F.slice(raw, a, size), "")
        # Full cuts go on until the rest has fewer tokens than ``most``; the rest is one piece.
        full = F.get(F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (left(i) < most)), F.lit(0))

        def joined(k: Column) -> Column:
            heads = F.transform(F.sequence(F.lit(0), k - 1), lambda i: part(i * piece + 1, F.lit(piece)))
            rest = part(k * piece + 1, F.size(raw))
            return F.when(F.trim(rest) == "", heads).otherwise(F.concat(heads, F.array(rest)))

        count = F.aggregate(solid, F.lit(0), lambda a, x: a + x)
        return F.when(count > most, let(full, joined)).otherwise(F.array(F.array_join(raw, "")))

    return let(pieces(sentence), cut)


def tagger_sentences(title: Column | str, abstract: Column | str) -> Column:
    """Sentences of a document for tagging: a short title stays whole, the abstract's first gets a blank before it."""
    cut = lambda c: F.flatten(F.transform(split_sentences(c), lambda s: cut_sentence(s)))
    none = F.array().cast("array<string>")
    blank = lambda a: (F.size(a) == 1) & (F.trim(F.get(a, F.lit(0))) == "")
    head = F.when(F.size(tokens(title)) < 50, F.array(_as(title))).otherwise(cut(title))
    led = lambda a: F.transform(a, lambda s, i: F.when(i == 0, F.concat(F.lit(" "), s)).otherwise(s))
    return F.concat(
        let(head, lambda a: F.when(blank(a), none).otherwise(a)),
        let(cut(abstract), lambda a: F.when(blank(a) | (F.length(_as(abstract)) == 0), none).otherwise(led(a))),
    )


def sentence_spans(content: Column | str) -> Column:
    """sent_no (from 1), start and end (exclusive) of the sentences for the graph, outer blanks left out."""
    return F.arrow_udf(scan.sentences, "array<struct<sent_no:int,start:int,end:int>>")(_as(content))


def occurrences(content: Column, surface: Column) -> Column:
    """start and end (exclusive) of every place where ``surface`` stands between other characters than ASCII letters and digits."""
    quoted = F.concat(F.lit(r"(?<![0-9A-Za-z])\Q"), surface, F.lit(r"\E(?![0-9A-Za-z])"))
    lengths = F.transform(F.split(content, quoted), F.length)
    size = F.length(surface)
    at = F.transform(running_starts(lengths), lambda s, i: s + i * size)
    # A part begins behind an occurrence; the first part begins at 0.
    return let(at, lambda a: F.transform(F.slice(a, 2, F.size(a)), lambda s: F.struct((s - size).alias("start"), s.alias("end"))))


def chemical_key(c: Column | str) -> Column:
    """Lower case without blanks and punctuation: the key of chemical names."""
    return F.regexp_replace(F.lower(_as(c)), f"[ {PUNCTUATION}]", "")


def basic_key(c: Column | str) -> Column:
    """Lower case, runs of blanks and punctuation to one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(_as(c)), rf"[\s{PUNCTUATION}]+", " "))


def correct_spelling(c: Column, typos: dict[str, str]) -> Column:
    """Word by word; what isn't listed stays."""
    if not typos:
        return c
    table = F.create_map(*[F.lit(x) for pair in typos.items() for x in pair])
    return F.array_join(F.transform(F.split(c, r"\s+"), lambda t: F.coalesce(F.try_element_at(table, t), t)), " ")


def clean_phrase(c: Column | str, lower: bool = True, typos: dict[str, str] | None = None, punctuation: bool = True, ignore: str = "") -> Column:
    """Lower case, spelling, punctuation to blanks (``ignore`` stays), trimmed; each step optional."""
    out = F.lower(_as(c)) if lower else _as(c)
    out = correct_spelling(out, typos or {})
    if punctuation:
        marks = "".join("\\" + chr(i) for i in (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)) if chr(i) not in ignore)
        out = F.regexp_replace(out, rf"[\s{marks}]+", " ")
    return F.trim(out)


def variant_attributes(c: Column | str) -> Column:
    """``k:v;k:v`` as a map; the first colon parts key and value."""
    pairs = F.filter(F.split(_as(c), ";"), lambda p: p.contains(":"))
    key, value = (lambda p: F.substring_index(p, ":", 1)), (lambda p: F.regexp_replace(p, "^[^:]*:", ""))

    def build(items: Column) -> Column:
        keys = F.array_distinct(F.transform(items, key))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: value(F.get(F.filter(items, lambda p: key(p) == k), F.lit(0)))))

    return let(pairs, build)


def tighten_brackets(content: Column, long_form: Column) -> Column:
    """``( x )`` as ``(x)`` and ``[ x ]`` as ``[x]``, step by step, where the long form isn't found as it is."""
    once = F.regexp_replace(F.regexp_replace(long_form, r"\( ", "("), r" \)", ")")
    once = F.when(content.contains(long_form), long_form).otherwise(F.regexp_replace(F.regexp_replace(once, r"\[ ", "["), r" \]", "]"))
    return once


def number_variants(abbr: Column) -> Column:
    """An abbreviation with its singular or plural."""
    other = F.when(
        F.substring(abbr, -1, 1) == "s", F.substring(abbr, F.lit(1), F.length(abbr) - 1)
    ).otherwise(F.concat(abbr, F.lit("s")))
    return F.array(abbr, other)


def words_with_spans(c: Column | str) -> Column:
    """Words between white space with start and end (inclusive)."""
    parts = F.regexp_extract_all(_as(c), F.lit(r"(\s+|\S+)"), 0)
    return F.filter(_spans(parts, F.lit(0)), lambda x: F.regexp_replace(x["tok"], r"\s", "") != "")


def composite_ids(c: Column | str) -> Column:
    """The ids of a composite id, parted by ``+`` or ``|``."""
    return F.split(F.translate(_as(c), "+", "|"), r"\|")


def node_type(c: Column | str) -> Column:
    return F.substring_index(_as(c), ":", 1)


def node_name(c: Column | str) -> Column:
    """A node's id without its type."""
    return F.regexp_replace(_as(c), "^[^:]*:", "")
