"""Text expressions: blanks, names, tokens. All stay in Catalyst."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from . import values as V


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def cell(c: Column) -> Column:
    """A cell as read: blank and ``--`` are missing."""
    return F.nullif(blank_to_null(c), F.lit("--"))


def words_in(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def column_key(c: Column) -> Column:
    """Header text for comparison: no BOM, currency signs or encoding leftovers, lower case, single spaces."""
    plain = F.translate(F.lower(strip(F.regexp_replace(c, "^﻿", ""))), "£€$�Ââ ", "")
    return strip(squeeze(plain))


def name_tokens(name: Column) -> Column:
    """Tokens of the canonical key of a company name; null and empty names have none."""
    s = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[\"'`´“”‘’]", "")
    s = F.translate(s, "&", " ")
    s = F.regexp_replace(s, r"(?i)\.(?:" + "|".join(t.replace(".", r"\.") for t in V.TLDS) + r")(?=$|[\s,./])", " ")
    s = F.regexp_replace(s, r"(?U)\.(?=\w)", "")
    drop = words_in(V.CONNECTORS + V.LEGAL_SUFFIXES)
    kept = F.filter(F.split(F.regexp_replace(s, "[^a-z0-9]+", " "), " "), lambda t: (t != "") & ~F.array_contains(drop, t))
    flat = F.regexp_replace(F.array_join(kept, " "), r"^(?:(?:" + "|".join(V.ARTICLES) + r") (?=\S\S))+", "")
    flat = F.regexp_replace(flat, r"(?<=(?:^|\s)[a-z0-9])\s(?=[a-z0-9](?:\s|$))", "")
    return F.filter(F.split(flat, " "), lambda t: (t != "") & ~F.array_contains(words_in(V.LEGAL_SUFFIXES), t))


def name_key(name: Column) -> Column:
    return F.array_join(name_tokens(name), " ")


def match_name(name: Column) -> Column:
    """Name for matching only: without payment descriptors (three at most) and trailing web domains; never empty."""
    s = name
    for _ in range(3):
        s = F.regexp_replace(F.regexp_replace(s, f"(?i)^(?:{V.PAYMENT_PREFIX})", ""), r"^[ *\-:/.]+", "")
    s = F.regexp_replace(s, r"(?i)\.(?:" + "|".join(t.replace(".", r"\.") for t in V.TRAILING_TLDS) + r")\b.*$", "")
    return F.coalesce(F.nullif(strip(F.regexp_replace(s, r"(?U)\s{2,}", " ")), F.lit("")), name)


def initials(tokens: Column) -> Column:
    """Initials signature: tokens of up to three characters count in full, longer ones by their first; numbers not at all."""
    return F.array_join(F.transform(F.filter(tokens, lambda t: ~t.rlike("^[0-9]+$")), lambda t: F.when(F.length(t) <= 3, t).otherwise(F.substring(t, 1, 1))), "")


def is_active(status: Column) -> Column:
    return F.contains(F.lower(F.coalesce(status, F.lit(""))), F.lit("active"))


def is_adorned(name: Column) -> Column:
    return F.contains(name, F.lit("(")) | F.arrays_overlap(F.split(F.lower(name), r"\s+"), words_in(V.ADORNMENTS))


def gateway_clean(supplier: Column) -> Column:
    """Supplier without gateway names, isolated long numbers, encoding leftovers, and whatever follows Ltd or LLP."""
    edge = r"^[ ,.*\-]+|[ ,.*\-]+$"
    s = F.regexp_replace(F.regexp_replace(strip(F.regexp_replace(supplier, f"(?i){V.GATEWAY}", "")), r"\s{2,}", " "), edge, "")
    s = F.replace(F.replace(s, F.lit("ï¿½"), F.lit("")), F.lit("�"), F.lit(""))
    s = strip(F.regexp_replace(s, r"(?i)\b(Ltd|LLP)\b.*", "$1"))
    s = F.regexp_replace(F.regexp_replace(s, r"\s{2,}", " "), edge, "")
    for _ in range(3):
        s = F.regexp_replace(F.regexp_replace(s, f"(?i)^(?:{V.PAYMENT_PREFIX})", ""), r"^[ *\-:/.]+", "")
    s = F.regexp_replace(s, edge, "")
    return F.when(supplier.isNull() | (supplier == ""), supplier).otherwise(F.coalesce(F.nullif(s, F.lit("")), supplier))


#: Bytes 0x80-0x9F as a Windows code page shows them, and as Latin-1 does; made from the codec's own table.
_SHOWN = {b: bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
_WINDOWS, _LATIN = "".join(c for c in _SHOWN.values() if c), "".join(chr(b) for b, c in _SHOWN.items() if c)
_TAIL = "[\u0080-\u00BF" + re.escape(_WINDOWS) + "]"
#: A character's UTF-8 bytes, each shown as a character of its own.
DAMAGED = f"[\u00C2-\u00DF]{_TAIL}|[\u00E0-\u00EF]{_TAIL}{{2}}|[\u00F0-\u00F4]{_TAIL}{{3}}"
#: What such bytes may stand for: letters and signs of European text, and bytes of a deeper layer.
PLAUSIBLE = "^[\u0080-\u024F\u1E00-\u1EFF\u2010-\u2027\u2030-\u203A\u20AC\u2116\u2122\u2212\uFB00-\uFB04]$"


def _mend_once(c: Column) -> Column:
    """Each damaged character decoded from its bytes, if these are UTF-8 of something plausible; the rest as it is."""

    def decoded(x: Column) -> Column:
        plain = F.try_validate_utf8(F.encode(F.translate(x, _WINDOWS, _LATIN), "ISO-8859-1").cast("string"))
        return F.when(plain.rlike(PLAUSIBLE), plain).otherwise(x)

    between = F.split(c, DAMAGED, -1)
    found = F.transform(F.regexp_extract_all(c, F.lit(DAMAGED), F.lit(0)), decoded)
    both = F.flatten(F.zip_with(between, found, lambda a, b: F.array(a, F.coalesce(b, F.lit("")))))
    return F.when(c.rlike(DAMAGED), F.array_join(both, "")).otherwise(c)


def repair_encoding(c: Column, layers: int = 4) -> Column:
    """UTF-8 that was read as Latin-1 or Windows-1252, up to ``layers`` times, put right layer by layer; sound text stays."""
    for _ in range(layers):
        c = let(c, _mend_once)
    return c


def let(value: Column, use) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def supplier_clean(supplier: Column, exact: dict[str, str] | None = None, patterns: list[tuple[str, str]] | None = None) -> Column:
    """The ordered supplier clean-up; ``exact`` then the first matching of ``patterns`` replace the whole name."""
    s = repair_encoding(supplier)
    s = F.regexp_replace(s, r"(?U)(?<=\w)\?(?=\w)", "")
    s = F.regexp_replace(s, r"(?U)(?<=\w)&(?=\w)", " & ")

    s = F.replace(s, F.lit(","), F.lit(""))
    s = F.regexp_replace(s, r"(?iU)\bwww(?=[a-z])", "www.")
    s = F.regexp_replace(s, r"(?iU)\bwww\b", "www")
    s = F.regexp_replace(s, r"(?iU)\bwww\.amazon\b.*", "Amazon")
    exact, patterns = exact or {}, patterns or []
    return let(let(s, lambda s: _known_name(s, exact, patterns)), _tidy_name)


def _known_name(s: Column, exact: dict[str, str], patterns: list[tuple[str, str]]) -> Column:
    """The supplier that a whole name or the first matching pattern stands for, else the name."""
    names = {k.upper(): v for k, v in exact.items()}
    known = [F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.upper(strip(s)))] if names else []
    return F.coalesce(*known, *[F.when(s.rlike(f"(?iU){k}"), F.lit(v)) for k, v in patterns], s)


def _tidy_name(s: Column) -> Column:
    """Signs, brackets and legal forms of a name in one way."""
    s = F.translate(s, '_"', "")
    for pattern in (r"\(.*?\)", r"\[.*?\]", r"\([^)]*$", r"\[[^\]]*$"):
        s = F.regexp_replace(s, pattern, "")
    s = F.when(F.startswith(s, F.lit("@")), F.regexp_replace(s, "^@", "")).otherwise(F.regexp_replace(s, "@.*", ""))
    s = F.translate(s, "~", "")
    s = F.regexp_replace(s, r"(?iU)\bL\.?\s*T\.?\s*D\.?", "Ltd")
    s = F.regexp_replace(s, r"(?iU)\bP\.?\s*L\.?\s*C\.?", "Plc")
    s = F.regexp_replace(s, r"(?iU)\b(?:Limited|Limi|Lim|Limted|Limit|Ltda|Ltd|Lltd)\b", "Ltd")
    s = F.regexp_replace(s, r"(?iU)(?<=\w)\s+L[TI]$", " Ltd")
    s = F.regexp_replace(s, r"(?iU)\bPLC\b", "Plc")
    s = F.regexp_replace(s, r"(?iU)\bLtd\b\.?.*", "Ltd")
    s = F.regexp_replace(s, r"(?iU)\bLLP\b\.?.*", "LLP")
    s = F.regexp_replace(s, r"(?iU)\b(?:T/A|Trading\s+As|C/O)\b.*", "")
    return strip(squeeze(s))


def comparison_key(name: Column) -> Column:
    """Upper-case key for finding spellings of one supplier."""
    s = F.regexp_replace(F.replace(F.upper(name), F.lit("'"), F.lit("")), r"(?U)\b(\w+?)S\b", "$1")
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)\s*&\s*", " AND "), r"(?U)(?<=\w)-(?=\w)", "")
    return strip(squeeze(F.regexp_replace(s, r"(?U)\s+(?:LTD|LLP|PLC)\.?\s*$", "")))


def initial_caps(name: Column, acronyms: list[str] | None = None) -> Column:
    """Each word capitalised, acronyms upper case without signs; without a list, all-caps words with no vowel stay."""
    core = lambda w: F.regexp_replace(w, "[^A-Za-z]", "")
    cap = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(w.substr(F.lit(2), F.length(w))))

    def word(w: Column) -> Column:
        c = core(w)
        keep = F.array_contains(words_in([a.upper() for a in acronyms]), F.upper(c)) if acronyms else F.lit(False)
        vowelless = F.lit(False) if acronyms else (c == F.upper(c)) & (F.length(c) > 1) & ~c.rlike("[AEIOUaeiou]")
        return F.when(c == "", w).when(keep, F.upper(c)).when(vowelless, w).otherwise(cap(w))

    return F.array_join(F.transform(F.split(strip(squeeze(name)), " "), word), " ")


def is_supplier(name: Column, borough: Column, filename: Column, amount: Column, exempt_header: Column) -> Column:
    """May a fact row have this supplier? Blank or single characters pass only for publishers known for them."""
    short = name.isNull() | (F.length(name) < 2)
    b = F.lower(strip(F.coalesce(borough, F.lit(""))))
    sutton = ~F.contains(F.lower(filename), F.lit("lbs-payments-ove-500")) & ~(strip(F.coalesce(amount, F.lit(""))) == "0")
    allowed = F.when(b == "ealing", exempt_header).when(b.isin(V.SHORT_NAME_BOROUGHS), F.lit(True)).when(b == "sutton", sutton).otherwise(F.lit(False))
    return F.when(short, allowed).otherwise(strip(name).rlike(r"^\*{4,}$") | name.rlike("[A-Za-z]"))


def strip_code_prefix(c: Column) -> Column:
    return F.regexp_replace(c, r"^[A-Za-z]?\d{4,}\s+", "")


def strip_junk(c: Column) -> Column:
    for junk in ("ï¿½ï¿½", "��", "_f"):
        c = F.replace(c, F.lit(junk), F.lit(""))
    return c


def payment_label(path: Column) -> Column:
    low = F.lower(path)
    found = F.lit(False)
    for w in V.CARD_WORDS:
        found = found | F.contains(low, F.lit(w))
    return F.when(found, "Card").otherwise("Main")


def title_header(c: Column) -> Column:
    """Header in title case; words of mixed case and ID, VAT, URI stay as they are."""
    word = lambda w: F.when(F.upper(w).isin("ID", "VAT", "URI"), F.upper(w)).when((w != F.lower(w)) & (w != F.upper(w)), w).otherwise(F.initcap(w))
    return F.array_join(F.transform(F.split(c, " "), word), " ")


def plain_cell(c: Column) -> Column:
    """Typographic signs as ASCII, a lost sign as the pound sign it mostly was."""
    return F.translate(c, "�‘’“”–— ­", "£''\"\"-- ")


def link_text(c: Column) -> Column:
    """Text of a download link without sizes, formats and extensions."""
    for p in (r"(?i)\(\s*[^()]*\b\d+(?:\.\d+)?\s*(?:kb|mb|gb)\s*\)", r"(?i)\(\s*(?:csv|xlsx?|pdf)\s*\)", r"(?i)\b(?:csv|xlsx?|pdf)\s*[-–,]\s*\d+(?:\.\d+)?\s*(?:kb|mb|gb)\b", r"(?i)\b\d+(?:\.\d+)?\s*(?:kb|mb|gb)\b", r"(?i)\.(?:csv|xlsx?|pdf)\b", r"(?i)\b(?:csv|xlsx?|pdf)\b", r"(?i)\bdocument\b"):
        c = F.regexp_replace(c, p, " ")
    return strip(squeeze(F.regexp_replace(c, r"\(\s*\)", " ")))


def safe_filename(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, r'[<>:"/\\|?*\x00-\x1f]', "_"), r"(?U)\s+", " "))


def company_numbers(note: Column) -> Column:
    """Registration numbers in a note: two letters and six digits or eight digits; else runs of six or seven, padded to eight."""
    up = F.upper(F.coalesce(note, F.lit("")))
    full = F.regexp_extract_all(up, F.lit(r"\b([A-Z]{2}[0-9]{6}|[0-9]{8})\b"), 1)
    short = F.transform(F.regexp_extract_all(up, F.lit(r"\b([0-9]{6,7})\b"), 1), lambda n: F.lpad(n, 8, "0"))
    return F.array_distinct(F.when(F.size(full) > 0, full).otherwise(short))


def stem(t: Column) -> Column:
    n = F.length(t)
    cut = lambda k: t.substr(F.lit(1), n - k)
    return F.when(F.endswith(t, F.lit("ies")) & (n > 4), F.concat(cut(3), F.lit("y"))).when(F.endswith(t, F.lit("es")) & (n > 4), cut(2)).when(F.endswith(t, F.lit("s")) & (n > 3), cut(1)).otherwise(t)


def distinctive(tokens: Column) -> Column:
    dull = words_in(V.GENERIC_WORDS + V.RESIDUE_WORDS)
    kept = F.filter(tokens, lambda t: ~F.array_contains(dull, t) & ~t.rlike("^[0-9]+$") & (F.length(t) > 1))
    return F.array_distinct(F.transform(kept, stem))


def match_tier(ours: Column, theirs: Column, anchor_df: Column, most: int = 25_000) -> Column:
    """clean, head_modifier, loose or weak: how far distinctive stems of two names agree."""
    s, c = distinctive(ours), distinctive(theirs)
    shared = F.array_intersect(s, c)
    left, right = F.size(F.array_except(s, c)), F.size(F.array_except(c, s))
    head = stem(F.get(ours, F.lit(0)))
    head_ok = (head == stem(F.get(theirs, F.lit(0)))) & F.array_contains(shared, head) & (left == 0)
    return F.when(F.size(shared) == 0, "weak").when(anchor_df > most, "loose").when((left == 0) & (right == 0), "clean").when(F.coalesce(head_ok, F.lit(False)), "head_modifier").otherwise("loose")


def differences(ours: Column, theirs: Column) -> dict[str, Column]:
    """What sets two token lists apart: shared and extra tokens, six flags and the first that applies."""
    extra_t, extra_s = F.array_except(theirs, ours), F.array_except(ours, theirs)
    shared = F.array_intersect(ours, theirs)
    generic, residue = words_in(V.GENERIC_WORDS), words_in(V.RESIDUE_WORDS)
    tail = lambda x: F.slice(x, F.greatest(F.size(x) - 1, F.lit(1)), F.lit(2))
    trailing = lambda extra, toks: F.size(F.array_intersect(F.array_intersect(extra, generic), tail(toks))) > 0
    prefix = F.exists(extra_s, lambda a: F.exists(extra_t, lambda b: (a != b) & (F.least(F.length(a), F.length(b)) >= 4) & (F.startswith(a, b) | F.startswith(b, a))))
    flags = {
        "block_miss": (F.size(ours) > 0) & (F.size(theirs) > 0) & (F.get(ours, F.lit(0)) != F.get(theirs, F.lit(0))),
        "abbrev_expansion": F.arrays_overlap(extra_t, residue),
        "trailing_generic": trailing(extra_s, ours) | trailing(extra_t, theirs),
        "plural_stem": F.arrays_overlap(F.transform(extra_s, stem), F.transform(extra_t, stem)),
        "prefix_abbrev": prefix,
    }
    flags = {k: F.coalesce(v, F.lit(False)) for k, v in flags.items()}
    flags["extra_token_only"] = (F.size(shared) > 0) & ((F.size(extra_s) == 0) | (F.size(extra_t) == 0)) & ~flags["abbrev_expansion"] & ~flags["trailing_generic"]
    first = F.coalesce(*[F.when(flags[k], F.lit(k)) for k in ("abbrev_expansion", "plural_stem", "prefix_abbrev", "trailing_generic", "extra_token_only", "block_miss")], F.lit("other"))
    return {"shared": shared, "extra_registry": extra_t, "extra_supplier": extra_s, **{f"cat_{k}": v for k, v in flags.items()}, "primary_category": first}
