"""Reading HTML with regular expressions, inside the JVM.

Patterns are linear: no nested repetition, and loops over tags and quotes are possessive. The
functions take and give SQL text (see ``sql``): a page needs many small expressions with lambdas, and
one parsed text per field is far cheaper to set up than hundreds of calls.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from adlattice.functions.scalars import BLANK_CHARS

sql = F.expr

# Named entities decoded besides numeric ones (fixed values). The ampersand must come last.
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "middot": "·",
    "hellip": "…", "ndash": "–", "mdash": "—", "laquo": "«", "raquo": "»", "deg": "°", "euro": "€", "frac12": "½",
    "aring": "å", "Aring": "Å", "aelig": "æ", "AElig": "Æ", "oslash": "ø", "Oslash": "Ø",
    "auml": "ä", "Auml": "Ä", "ouml": "ö", "Ouml": "Ö", "uuml": "ü", "Uuml": "Ü", "eacute": "é", "Eacute": "É",
    "amp": "&",
}

HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b.*?</\1\s*>"
# The rest of an opening tag after its name; quoted values may contain '>'.
TAG_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_TRIMMED = f"btrim({{}}, {quoted(BLANK_CHARS)})"
# Entities that most pages use; a text is looked through for the others only if it has any.
COMMON_ENTITIES = ["lt", "gt", "quot", "apos", "amp"]
_RARE = {n: c for n, c in ENTITIES.items() if n not in COMMON_ENTITIES}
_RARE_PAIRS = ", ".join(f"struct({quoted(f'&{n};')} AS name, {quoted(c)} AS char)" for n, c in _RARE.items())
_RARE_MARK = quoted(f"&(?:{'|'.join(_RARE)});")


def trimmed(text: str) -> str:
    return _TRIMMED.format(text)


def _numeric_entities(name: str) -> str:
    """Decode &#229; and &#xe5; in the text of a variable."""
    between = f"split({name}, '&#x?[0-9a-fA-F]{{1,6}};')"
    codes = f"regexp_extract_all({name}, '&#(x?[0-9a-fA-F]{{1,6}});', 1)"
    digits = "if(startswith(c, 'x'), substring(c, 2, 6), conv(c, 10, 16))"
    character = f"decode(unhex(lpad({digits}, 8, '0')), 'UTF-32')"
    rest = f"zip_with({codes}, slice({between}, 2, size({between})), (c, r) -> concat({character}, coalesce(r, '')))"
    return f"if(contains({name}, '&#'), concat(get({between}, 0), array_join({rest}, '')), {name})"


def _decoded(name: str) -> str:
    """Decode entities in the text of a variable, only if it has any."""
    rare = f"aggregate(array({_RARE_PAIRS}), n, (done, e) -> replace(done, e.name, e.char))"
    named = f"if(n RLIKE {_RARE_MARK}, {rare}, n)"
    for entity in COMMON_ENTITIES:
        named = f"replace({named}, {quoted(f'&{entity};')}, {quoted(ENTITIES[entity])})"
    return f"if(contains({name}, '&'), {once(_numeric_entities(name), 'n', named)}, {name})"


def once(value: str, name: str, use: str) -> str:
    """``use`` with the variable ``name`` bound to ``value``, so that the value is computed once."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def decode_entities(text: str) -> str:
    return once(text, "d", _decoded("d"))


def visible_text(html: str, separator: str = " ") -> str:
    """Text pieces between tags, each trimmed, empty ones dropped, joined by ``separator``.

    Comments, scripts and styles are left out. A text without any tag is one piece.
    """
    pieces = f"split(regexp_replace(h, {quoted(HIDDEN)}, ''), '<[^>]*>')"
    texts = f"transform({pieces}, p -> {trimmed(_decoded('p'))})"
    joined = f"array_join(filter({texts}, t -> t != ''), {quoted(separator)})"
    return once(html, "h", f"if(contains(h, '<'), {joined}, {trimmed(_decoded('h'))})")


def non_empty_sql(text: str) -> str:
    return f"nullif({text}, '')"


def attribute(tag: str, name: str) -> str:
    """Decoded value of an attribute in the text of an opening tag, NULL if absent or empty."""
    pattern = quoted(rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
    bare = "if(left(v, 1) IN ('\"', '\\''), substring(v, 2, length(v) - 2), v)"
    return decode_entities(non_empty_sql(once(f"regexp_extract({tag}, {pattern}, 1)", "v", bare)))


def has_classes(*classes: str) -> str:
    """Pattern for a tag's rest that carries all classes, in any order."""
    tokens = "".join(rf"""(?=(?:[^"'>]*\s)?{c}[\s"'])""" for c in classes)
    return rf"""(?=[^>]*\sclass\s*=\s*["']{tokens})"""


def has_attribute(name: str, value: str) -> str:
    return rf"""(?=[^>]*\s{name}\s*=\s*["']{value}["'])"""


def open_tag(names: str, condition: str = "") -> str:
    """Pattern of an opening tag of any of ``names`` (alternatives) that meets a condition."""
    return rf"(?is)<(?:{names})\b{condition}[^>]*>"


def element(name: str, condition: str = "") -> str:
    """Pattern of an element that does not contain itself; group 1 is its content."""
    return rf"(?is)<{name}\b{condition}[^>]*>(.*?)</{name}\s*>"


def holding(html: str, lowered: str, mark: str) -> str:
    """The page if its text in lower case holds ``mark``, else '', so that a pattern with that mark looks through no page without it."""
    return f"if(contains({lowered}, {quoted(mark.lower())}), {html}, '')"


def first_match(html: str, pattern: str, group: int = 0) -> str:
    return non_empty_sql(f"regexp_extract({html}, {quoted(pattern)}, {group})")


def all_matches(html: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({html}, {quoted(pattern)}, {group})"


def texts_of(html: str, pattern: str, group: int = 1, separator: str = " ") -> str:
    """Visible texts of all matches, empty ones dropped."""
    return f"filter(transform({all_matches(html, pattern, group)}, m -> {visible_text('m', separator)}), t -> t != '')"


def label_value_pairs(html: str, pattern: str, label: int, value: int) -> str:
    """Array of (label, value): label in lower case, both as tight visible text, empty ones dropped."""
    pair = f"struct(lower({visible_text('l', '')}) AS label, {visible_text('v', '')} AS value)"
    pairs = f"zip_with({all_matches(html, pattern, label)}, {all_matches(html, pattern, value)}, (l, v) -> {pair})"
    return f"filter({pairs}, x -> x.label != '' AND x.value != '')"


def last_value(pairs: str, label: str) -> str:
    """Value of the last pair with this label in a column of label and value pairs."""
    # The position is 0 without such a pair, for which NULL is the index.
    return f"get(reverse({pairs}.value), int(nullif(array_position(reverse({pairs}.label), {quoted(label)}), 0)) - 1)"


def headed_blocks(html: str) -> str:
    """Array of (heading, body, in_section): each h2 with the HTML after it, up to the next h2 or section end."""
    heading = visible_text(f"regexp_extract(b, {quoted(r'(?is)^<h2[^>]*>(.*?)</h2[ ]*>')}, 1)", "")
    inside = f"get(split(b, {quoted(r'(?i)</section[ ]*>')}, 2), 0)"
    body = f"regexp_extract({inside}, {quoted(r'(?is)^<h2[^>]*>.*?</h2[ ]*>(.*)$')}, 1)"
    closed = f"b RLIKE {quoted(r'(?i)</section[ ]*>')}"
    pieces = f"filter(split({html}, {quoted(r'(?i)(?=<h2[ >])')}), b -> lower(left(b, 3)) = '<h2')"
    return f"transform({pieces}, b -> struct({heading} AS heading, {body} AS body, {closed} AS in_section))"


def block_under(blocks: str, heading: str) -> str:
    """Body under the first heading that reads ``heading``."""
    return f"get(filter({blocks}, x -> lower(x.heading) = {quoted(heading)}), 0).body"
