"""Text functions. Equality is case-insensitive except in EXACT, FIND and SUBSTITUTE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.base import c, fn, num, ok

_S = lambda x: F.coalesce(c(x).cast("string"), F.lit(""))  # noqa: E731  blank text is empty
_I = lambda x: c(x).cast("int")

fn("CONCATENATE", "CONCAT")(lambda *x: F.concat(*map(_S, x)))
fn("LEFT")(lambda s, n=1: ok(_I(n) >= 0, F.substring(_S(s), F.lit(1), _I(n))))
fn("MID")(lambda s, start, n: ok((_I(start) >= 1) & (_I(n) >= 0), F.substring(_S(s), _I(start), _I(n))))
fn("LEN")(lambda s: F.char_length(_S(s)))
fn("TRIM")(lambda s: F.regexp_replace(F.trim(_S(s)), " +", " "))
fn("CLEAN")(lambda s: F.regexp_replace(_S(s), r"[\x00-\x1F\x7F]", ""))
fn("UPPER")(lambda s: F.upper(_S(s)))
fn("LOWER")(lambda s: F.lower(_S(s)))
fn("REPT")(lambda s, n: ok(_I(n) >= 0, F.repeat(_S(s), _I(n))))
fn("CHAR")(lambda n: ok((num(n) >= 1) & (num(n) <= 255), F.char(_I(n))))
fn("CODE", "UNICODE")(lambda s: ok(_S(s) != "", F.ascii(_S(s))))
fn("EXACT")(lambda a, b: _S(a) == _S(b))
fn("REGEXTEST")(lambda s, pattern, fold=0: F.rlike(_S(s), F.concat(F.lit("(?i)" if fold else ""), c(pattern))))
fn("REGEXEXTRACT")(lambda s, pattern, fold=0: F.regexp_substr(_S(s), F.concat(F.lit("(?i)" if fold else ""), c(pattern))))
fn("HYPERLINK")(lambda url, label=None: _S(url) if label is None else _S(label))
fn("T")(lambda x, of="string": _S(x) if of == "string" else F.lit(""))


@fn("RIGHT")
def right(s, n=1) -> Column:
    s, n = _S(s), _I(n)
    return ok(n >= 0, F.substring(s, F.greatest(F.char_length(s) - n + 1, F.lit(1)), n))


@fn("TEXTJOIN")
def text_join(delimiter, skip_empty: bool, *values) -> Column:
    parts = F.array(*map(_S, values))
    return F.array_join(F.filter(parts, lambda v: v != "") if skip_empty else parts, delimiter)


def text_join_group(delimiter: str, skip_empty: bool, value: Column, order: Column) -> Column:
    """TEXTJOIN over a group's rows in an order, as an aggregate."""
    kept = F.when(_S(value) != "", F.struct(order.alias("o"), _S(value).alias("v"))) if skip_empty else F.struct(order.alias("o"), _S(value).alias("v"))
    return F.array_join(F.transform(F.array_sort(F.collect_list(kept)), lambda e: e["v"]), delimiter)


@fn("PROPER")
def proper(s) -> Column:
    """A capital after anything that is not a letter."""
    letters = F.split(F.lower(_S(s)), "")
    cased = F.transform(letters, lambda ch, i: F.when((i == 0) | ~F.coalesce(F.rlike(F.get(letters, i - 1), F.lit(r"\p{L}")), F.lit(False)), F.upper(ch)).otherwise(ch))
    return F.array_join(cased, "")


@fn("UNICHAR")
def unichar(n) -> Column:
    """A code point as UTF-8, built from its bytes."""
    n = _I(n)
    tail = lambda shift: F.lit(128) + F.shiftright(n, shift).bitwiseAND(F.lit(63))
    made = (
        F.when(n < 128, F.array(n))
        .when(n < 2048, F.array(F.lit(192) + F.shiftright(n, 6), tail(0)))
        .when(n < 65536, F.array(F.lit(224) + F.shiftright(n, 12), tail(6), tail(0)))
        .otherwise(F.array(F.lit(240) + F.shiftright(n, 18), tail(12), tail(6), tail(0)))
    )
    text = F.decode(F.unhex(F.array_join(F.transform(made, lambda b: F.lpad(F.hex(b), 2, "0")), "")), "UTF-8")
    return ok((n > 0) & (n <= 1114111) & ~n.between(55296, 57343), text)


_WIDE = "[ᄀ-ᅟ⺀-꓏가-힣豈-﫿︰-﹯＀-｠￠-￦]"
fn("LENB")(lambda s: F.char_length(_S(s)) + F.char_length(_S(s)) - F.char_length(F.regexp_replace(_S(s), _WIDE, "")))
_FULL = "".join(map(chr, range(0xFF01, 0xFF5F))) + "　"
fn("ASC")(lambda s: F.translate(_S(s), _FULL, "".join(map(chr, range(0x21, 0x7F))) + " "))
fn("FIND")(lambda find, within, start=1: F.nullif(F.locate(find, _S(within), start) if isinstance(find, str) else F.position(_S(find), _S(within), _I(start)), F.lit(0)))


def wildcard_regex(pattern: str, whole: bool = True) -> str:
    """Spreadsheet wildcards as a regular expression: * any run, ? one character, ~ makes the next plain."""
    out, i = "", 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "~" and i + 1 < len(pattern) and pattern[i + 1] in "*?~":
            i += 1
            ch = pattern[i]
            out += "\\" + ch if ch != "~" else "~"
        elif ch in "*?":
            out += ".*" if ch == "*" and whole else ".*?" if ch == "*" else "."
        else:
            out += ch if ch.isalnum() or ch.isspace() or ord(ch) > 127 else "\\" + ch
        i += 1
    return "(?is)" + (f"^{out}$" if whole else out)


@fn("SEARCH")
def search(find: str, within, start: int = 1) -> Column:
    """Case-insensitive position with wildcards, NULL when absent."""
    rest = F.substring(_S(within), F.lit(start), F.char_length(_S(within)))
    at = F.regexp_instr(rest, F.lit(wildcard_regex(find, whole=False)))
    return ok(at > 0, at + (start - 1))


fn("REPLACE")(lambda s, start, n, new: F.concat(F.substring(_S(s), F.lit(1), _I(start) - 1), _S(new), F.substring(_S(s), _I(start) + _I(n), F.char_length(_S(s)) + 1)))


@fn("SUBSTITUTE")
def substitute(s, old: str, new: str, instance: int | None = None) -> Column:
    s = _S(s)
    if not old:
        return s
    if instance is None:
        return F.replace(s, F.lit(old), F.lit(new))
    parts = F.split(s, "\\Q" + old + "\\E", -1)
    head, tail = F.slice(parts, 1, instance), F.slice(parts, F.lit(instance + 1), F.greatest(F.size(parts) - instance, F.lit(0)))
    return F.when(F.size(parts) > instance, F.concat(F.array_join(head, old), F.lit(new), F.array_join(tail, old))).otherwise(s)


@fn("REGEXREPLACE")
def regex_replace(s, pattern: str, new: str, occurrence: int = 0, fold: int = 0) -> Column:
    """Occurrence 0 replaces all, n the n-th."""
    pattern = ("(?i)" if fold else "") + pattern
    if not occurrence:
        return F.regexp_replace(_S(s), pattern, new)
    found = F.regexp_extract_all(_S(s), F.lit(f"({pattern})"), F.lit(1))
    parts = F.split(_S(s), pattern, -1)
    pieces = F.transform(parts, lambda p, i: F.concat(p, F.when(i == occurrence - 1, F.when(F.get(found, i).isNotNull(), F.lit(new)).otherwise("")).otherwise(F.coalesce(F.get(found, i), F.lit("")))))
    return F.array_join(pieces, "")


def _cut(s, delimiter: str, instance: int, before: bool, match_end: int, missing, fold: int) -> Column:
    s = _S(s)
    parts = F.split(s, ("(?i)" if fold else "") + "\\Q" + delimiter + "\\E", -1)
    n = F.size(parts) - 1
    at = F.lit(instance) if instance > 0 else n + 1 + instance
    if fold:  # the delimiters as they stand in the text
        taken = F.regexp_extract_all(s, F.lit(f"(?i)(\\Q{delimiter}\\E)"), F.lit(1))
    else:
        taken = F.array_repeat(F.lit(delimiter), F.greatest(n, F.lit(0)))
    join = lambda a, d: F.array_join(F.transform(a, lambda p, i: F.concat(p, F.when(i < F.size(a) - 1, F.coalesce(F.get(d, i), F.lit(""))).otherwise(""))), "")
    head = join(F.slice(parts, F.lit(1), F.greatest(at, F.lit(0))), taken)
    tail = join(F.slice(parts, F.greatest(at, F.lit(0)) + 1, F.size(parts)), F.slice(taken, F.greatest(at, F.lit(0)) + 1, F.size(parts)))
    found = (at >= 1) & (at <= n)
    whole = s if before else F.lit("")
    return F.when(found, head if before else tail).otherwise(F.when((at == n + 1) & F.lit(bool(match_end)), whole).otherwise(c(missing)))


fn("TEXTBEFORE")(lambda s, d, instance=1, fold=0, match_end=0, missing=None: _cut(s, d, instance, True, match_end, missing, fold))
fn("TEXTAFTER")(lambda s, d, instance=1, fold=0, match_end=0, missing=None: _cut(s, d, instance, False, match_end, missing, fold))
fn("VALUETOTEXT")(lambda x, strict=0, of="string": F.concat(F.lit('"'), F.replace(_S(x), F.lit('"'), F.lit('""')), F.lit('"')) if strict and of == "string" else _S(x))
fn("ARRAYTOTEXT")(lambda a, strict=0: F.concat(F.lit("{"), F.array_join(a.cast("array<string>"), ","), F.lit("}")) if strict else F.array_join(a.cast("array<string>"), ", "))


fn("N")(lambda x: F.when(F.typeof(c(x)).isin("string", "void"), 0.0).otherwise(F.coalesce(c(x).try_cast("double"), F.lit(0.0))))


@fn("VALUE")
def value(s) -> Column:
    """Numbers, percentages, currency, dates (as serials) and times (as day fractions) in text."""
    from gridloom.functions.dates import date_value, time_value

    t = F.trim(_S(s))
    plain = F.regexp_replace(F.regexp_replace(t, r"^\(\s*(.*)\s*\)$", "-$1"), r"[$€£¥,\s]", "")
    percent = F.regexp_extract(plain, r"^(.*)%$", 1).try_cast("double") / 100
    # a word such as NaN or Infinity is no number
    number = F.when(F.rlike(plain, F.lit(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$")), plain.try_cast("double"))
    return F.coalesce(number, percent, date_value(t), time_value(t))


@fn("NUMBERVALUE")
def number_value(s, decimal: str = ".", group: str = ",") -> Column:
    t = F.regexp_replace(F.replace(_S(s), F.lit(group), F.lit("")), r"\s", "")
    t = F.replace(t, F.lit(decimal), F.lit("."))
    signs = F.char_length(F.regexp_extract(t, "(%*)$", 1))
    return F.when(t == "", F.lit(0.0)).otherwise(F.regexp_replace(t, "%+$", "").try_cast("double") / F.pow(F.lit(100.0), signs))


@fn("FIXED")
def fixed(x, digits: int = 2, plain: bool = False) -> Column:
    from gridloom.functions.math import round_half_away

    text = F.format_number(round_half_away(x, digits), max(digits, 0))
    return F.replace(text, F.lit(","), F.lit("")) if plain else text


def _money(sign: str, x, digits: int) -> Column:
    text = F.concat(F.lit(sign), fixed(F.abs(num(x)), digits))
    return F.when(num(x) < 0, F.concat(F.lit("("), text, F.lit(")"))).otherwise(text)


fn("DOLLAR")(lambda x, digits=2: _money("$", x, digits))
fn("YEN")(lambda x, digits=0: _money("¥", x, digits))


@fn("TEXT")
def text(x, code: str) -> Column:
    """Number-format codes: 0 # , . % E+ and literals for numbers; y m d h s and AM/PM for dates (serials)."""
    import re

    from gridloom.functions.dates import from_serial

    sections = code.split(";")
    if len(sections) > 1:
        negative, zero = text(F.abs(num(x)), sections[1]), text(x, sections[2] if len(sections) > 2 else sections[0])
        return F.when(num(x) < 0, negative).when(num(x) == 0, zero).otherwise(text(x, sections[0]))
    if code in ("@", "General"):
        return F.when(num(x) == F.floor(num(x)), num(x).cast("bigint").cast("string")).otherwise(num(x).cast("string"))
    bare = re.sub(r'"[^"]*"|\\.', "", code)
    if re.search(r"[ymdhs]", bare, re.I):
        ampm = re.search(r"AM/PM|A/P", code, re.I) is not None
        java, minutes = "", False
        for part in re.findall(r'"[^"]*"|AM/PM|A/P|y+|m+|d+|h+|s+|\\.|.', code, re.I):
            low = part.lower()
            if part[0] in '"\\':
                java += "'" + part.strip('"\\') + "'"
            elif low in ("am/pm", "a/p"):
                java += "a"
            elif low[0] == "y":
                java += "yyyy" if len(low) > 2 else "yy"
            elif low[0] == "h":
                java, minutes = java + ("h" if ampm else "H") * min(len(low), 2), True
            elif low[0] == "s":
                java = re.sub(r"M{1,2}(?=:?$)", lambda m: "m" * len(m[0]), java) + "s" * min(len(low), 2)
            elif low[0] == "m":
                java, minutes = java + ("m" if minutes and len(low) < 3 else "M") * min(len(low), 4), False
            elif low[0] == "d":
                java += {1: "d", 2: "dd", 3: "EEE"}.get(len(low), "EEEE")
            else:
                java += "'" + part + "'" if part.isalpha() else part
                minutes = minutes and part == ":"
        return F.date_format(from_serial(x), java)
    m = re.match(r"^(.*?)([#0,]*\.?[0#]*)(E[+-]0+)?(%*)(.*?)$", code)
    core = re.search(r"[#0][#0,]*(\.[0#]+)?(E\+0+)?", code)
    if not m or not core:
        return F.lit(code)
    pattern, literal = core[0], lambda s: re.sub(r'"([^"]*)"|\\(.)|_.|\*.', lambda k: k[1] or k[2] or "", s)
    before, after = literal(code[: core.start()]), literal(code[core.end() :])
    v = num(x) * 100 ** after.count("%")
    whole, _, rest = pattern.partition(".")
    places = len(re.match(r"[0#]*", rest)[0])
    if "E+" in pattern:
        power = F.floor(F.log10(F.abs(v)))
        return F.concat(F.lit(before), F.format_string(f"%.{places}f", v / F.pow(F.lit(10.0), power)), F.lit("E"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), pattern.count("0", pattern.index("E")), "0"), F.lit(after))
    shown = fixed(F.abs(v), places, plain="," not in whole)
    if rest.rstrip("#") != rest:  # optional decimals
        shown = F.regexp_replace(shown, rf"(\.[0-9]{{{rest.count('0')}}}[0-9]*?)0+$", "$1")
        shown = F.regexp_replace(shown, r"\.$", "")
    least = whole.replace(",", "").count("0")
    if least > 1:
        dot = F.concat(F.lit("."), F.substring_index(shown, ".", -1)) if places else F.lit("")
        shown = F.concat(F.lpad(F.substring_index(shown, ".", 1), F.greatest(F.lit(least), F.char_length(F.substring_index(shown, ".", 1))), F.lit("0")), dot)
    return F.concat(F.when((v < 0) & F.rlike(shown, F.lit("[1-9]")), "-").otherwise(""), F.lit(before), shown, F.lit(after))
