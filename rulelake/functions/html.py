"""HTML reading as native Column expressions.

The pages are machine-made markup, so tags are located with regular
expressions and text is produced the way an HTML tree's ``get_text`` does:
every text node is entity-decoded and stripped, empty nodes are dropped and
the rest joined with a separator. Everything here stays inside Catalyst
(no Python per row), so it runs in whole-stage codegen on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named character references: the HTML 5 table of the standard library (generated, not listed).


def _entity_table() -> str:
    """``name<TAB>characters`` lines, the most frequent names first (a map is
    searched in order). Two names that stand for the separators are left out;
    :func:`decode_entities` knows them."""
    from html.entities import html5

    first = ["nbsp", "amp", "lt", "gt", "quot", "apos", "middot", "copy", "mdash", "ndash", "hellip"]
    names = first + sorted(n[:-1] for n in html5 if n.endswith(";") and n[:-1] not in first)
    return "\n".join(f"{n}\t{html5[n + ';']}" for n in names if n not in ("Tab", "NewLine"))


def _legacy_names() -> str:
    """The names that count without ``;``, longest first, as a regex."""
    from html.entities import html5

    return "^(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"


_ENTITY_TABLE = _entity_table()
_LEGACY = _legacy_names()


def _entity_map() -> Column:
    """The name table as one foldable expression: the optimizer makes it a
    literal, so a plan holds four nodes for it and no entry of its own."""
    return F.str_to_map(F.lit(_ENTITY_TABLE), F.lit("\n"), F.lit("\t"))


NAMED_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"),
                  ("&middot;", "\u00b7"), ("&copy;", "\u00a9")]  # the ones the oracles spell out

# Python's str.strip() / str.split() treat Unicode white space as space;
# Java regex needs the UNICODE_CHARACTER_CLASS flag ``(?U)`` for the same.


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at(arr, i) -> Column:
    """1-based array element (negative counts from the end); NULL if out of range."""
    return F.try_element_at(_col(arr), i if isinstance(i, Column) else F.lit(i))


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once: a lambda variable stands for
    it, so an expression that reads it many times does not repeat it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def py_strip(c) -> Column:
    """``str.strip()``: drop leading and trailing Unicode white space."""
    return F.regexp_replace(_col(c), "(?U)^\\s+|\\s+$", "")


def collapse_ws(c) -> Column:
    """``" ".join(s.split())``: single spaces, no leading or trailing space."""
    return py_strip(F.regexp_replace(_col(c), "(?U)\\s+", " "))


def _windows_1252() -> list[str]:
    """What the references 128 to 159 stand for; undefined ones are themselves."""
    out = []
    for i in range(128, 160):
        try:
            out.append(bytes([i]).decode("cp1252"))
        except UnicodeDecodeError:
            out.append(chr(i))
    return out


def _code_point_text(cp: Column) -> Column:
    """Character of a numeric reference. 0, surrogates and numbers beyond
    Unicode (NULL stands for those too long to read) become U+FFFD, 128 to
    159 the Windows-1252 character."""
    bad = cp.isNull() | (cp <= 0) | ((cp >= 0xD800) & (cp <= 0xDFFF)) | (cp > 0x10FFFF)
    safe = F.when(bad, F.lit(0xFFFD)).otherwise(cp)
    western = F.substr(F.lit("".join(_windows_1252())), (safe - 127).cast("int"), F.lit(1))
    return F.when((safe >= 128) & (safe <= 159), western).otherwise(
        F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32"))


def _decoded(text: Column, named, legacy=None) -> Column:
    """``text`` with its character references replaced in one pass: it is split
    at ``&``, and a piece that starts with a reference begins with its
    characters instead, so ``&amp;lt;`` stays ``&lt;``."""
    def read(seg: Column, ref: Column, name: Column) -> Column:
        hexa = name.rlike("^#[xX]")
        digits = F.regexp_replace(name, "^#[xX]?0*", "")
        # NULL: more digits than any character has
        number = F.when(F.length(digits) > 8, F.lit(None)).when(digits == "", F.lit("0")).when(
            hexa, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
        chars = F.when(name.startswith("#"), let(number, _code_point_text)).otherwise(named(name))
        keep = F.concat(F.lit("&"), seg)
        return let(chars, lambda c: F.when((ref != "") & c.isNotNull(), F.concat(c, F.substr(seg, F.length(ref) + 1))).otherwise(
            keep if legacy is None else legacy(seg, keep)))

    def one(seg: Column) -> Column:
        ref = F.regexp_extract(seg, "^([A-Za-z][A-Za-z0-9]*;|#[0-9]+;?|#[xX][0-9a-fA-F]+;?)", 1)
        return let(ref, lambda r: let(F.regexp_replace(r, ";$", ""), lambda name: read(seg, r, name)))

    def whole(t: Column) -> Column:
        def joined(segs: Column) -> Column:
            rest = F.transform(F.slice(segs, F.lit(2), F.greatest(F.size(segs) - 1, F.lit(1))), one)
            return F.array_join(F.concat(F.array(at(segs, 1)), rest), "")

        return F.when(t.contains("&"), let(F.split(t, "&"), joined)).otherwise(t)

    return let(text, whole)


def decode_entities(c) -> Column:
    """Decode character references in one left-to-right pass: the HTML 5
    names with ``;``, the old names that need none, and all numeric ones. The
    name table is part of the plan, so use it once a plan; what reads
    :func:`markup.canonical` pages needs :func:`decode_basic` alone."""
    def named(name: Column) -> Column:
        return F.when(name == "Tab", F.lit("\t")).when(name == "NewLine", F.lit("\n")).otherwise(
            F.try_element_at(_entity_map(), name))

    def legacy(seg: Column, keep: Column) -> Column:
        return let(F.regexp_extract(seg, _LEGACY, 1), lambda name: F.when(name != "", F.concat(
            F.try_element_at(_entity_map(), name), F.substr(seg, F.length(name) + 1))).otherwise(keep))

    return _decoded(_col(c), named, legacy)


def decode_basic(c) -> Column:
    """Decodes the few names that saved pages are full of and numeric
    references; all others are gone from canonical pages."""
    def named(name: Column) -> Column:
        out = F.when(name == "amp", F.lit("&"))
        for ref, ch in NAMED_ENTITIES:
            out = out.when(name == ref[1:-1], F.lit(ch))
        return out

    def read(t: Column) -> Column:
        # an apostrophe is the one frequent numeric reference; without others, plain replacements do
        # (&amp; last, since what it leaves is not read again)
        rest = F.replace(t, F.lit("&#039;"), F.lit("'"))
        plain = rest
        for ref, ch in [*NAMED_ENTITIES, ("&amp;", "&")]:
            plain = F.replace(plain, F.lit(ref), F.lit(ch))
        return F.when(~t.contains("&"), t).when(~rest.contains("&#"), plain).otherwise(_decoded(t, named))

    return let(_col(c), read)


def node_text(fragment, sep: str = "") -> Column:
    """``get_text(sep, strip=True)`` of an HTML fragment.

    The fragment is split at its tags; every text node is decoded and
    stripped, empty ones go and the rest is joined with ``sep``. Without
    references the same is done by two replacements of runs of tags and white
    space, which need no array: ``<>`` cannot occur outside a tag there.
    """
    def read(marked: Column) -> Column:
        plain = F.regexp_replace(F.regexp_replace(marked, "(?U)^(?:\\s|<>)++|(?:\\s|<>)++$", ""), "(?U)\\s*+<>(?:\\s|<>)*+", sep)
        nodes = F.transform(F.split(marked, "<>"), lambda node: py_strip(decode_basic(node)))
        return F.when(marked.contains("&"), F.array_join(F.filter(nodes, lambda node: node != ""), sep)).otherwise(plain)

    return let(F.regexp_replace(_col(fragment), "<[^>]*>", "<>"), read)


def class_token(cls: str) -> str:
    """Regex fragment: an opening tag whose class attribute has token ``cls``."""
    return f'class="(?:[^"]*\\s)?{cls}(?:\\s[^"]*)?"'


def elements(html, tag: str, cls: str | None = None) -> Column:
    """All ``<tag ...>inner</tag>`` elements (no same-tag nesting), in order.

    Returns an array of the full element markup.
    """
    attrs = f"[^>]*{class_token(cls)}[^>]*" if cls else "[^>]*"
    return F.regexp_extract_all(
        _col(html), F.lit(f"(?s)<{tag}\\b{attrs}>.*?</{tag}>"), 0)


def inside(rest, tag: str) -> Column:
    """Markup up to the closing tag of the element whose opening tag stands
    just before ``rest`` (all of it if the element is not closed).

    Mostly no such tag is nested in it, and the text before the first closing
    tag is all. Else the text is cut at the tag's openings and closings and
    the depth is counted over the pieces, so neither length nor nesting is
    limited."""
    def walk(state: Column, seg: Column) -> Column:
        depth = F.when(state["depth"] > 0, state["depth"] + F.when(seg.startswith("/"), F.lit(-1)).otherwise(F.lit(1))) \
            .otherwise(F.lit(0))
        return F.struct(depth.alias("depth"), (state["kept"] + (depth > 0).cast("int")).alias("kept"))

    def cut(segs: Column) -> Column:
        # every piece but the first begins with the name of a tag, "/" before it where it closes
        kept = F.aggregate(F.slice(segs, F.lit(2), F.greatest(F.size(segs) - 1, F.lit(1))),
                           F.struct(F.lit(1).alias("depth"), F.lit(1).alias("kept")), walk, lambda s: s["kept"])
        return F.array_join(F.slice(segs, F.lit(1), kept), "<")

    def read(text: Column) -> Column:
        first = F.substring_index(text, f"</{tag}>", 1)
        return let(first, lambda f: F.when(~f.contains(f"<{tag}") & ~f.contains(f"</{tag}"), f).otherwise(
            let(F.split(text, f"<(?=/?{tag}\\b)"), cut)))

    return let(_col(rest), read)


def attr(tag_markup, name: str) -> Column:
    """Decoded value of attribute ``name`` of the first tag; NULL if absent."""
    def read(tag: Column) -> Column:
        raw = F.regexp_extract(tag, f'^<[^>]*?\\s{name}="([^"]*)"', 1)
        return F.when(tag.rlike(f'^<[^>]*?\\s{name}="'), decode_basic(raw))

    return let(_col(tag_markup), read)


def hrefs(html) -> Column:
    """All decoded href values of ``<a>`` tags, in page order."""
    raw = F.regexp_extract_all(_col(html), F.lit('<a\\s[^>]*?href="([^"]*)"'), 1)
    return F.transform(raw, decode_basic)


def handles(fragment) -> Column:
    """``a.phui-handle`` links -> array<struct<name, is_group>>.

    Name is the link text after its first space (``rFOO foo`` -> ``foo``),
    else the whole text. ``/tag/`` is a group, ``/p/`` a user, else NULL.
    """
    anchors = F.regexp_extract_all(
        _col(fragment),
        F.lit(f"(?s)<a\\b[^>]*{class_token('phui-handle')}[^>]*>.*?</a>"), 0)

    def to_struct(a: Column) -> Column:
        name = let(node_text(a, ""), lambda text: F.regexp_replace(text, "(?s)^[^ ]* ", ""))
        is_group = let(F.coalesce(attr(a, "href"), F.lit("")), lambda href: (
            F.when(href.startswith("/tag/"), F.lit(True)).when(href.startswith("/p/"), F.lit(False))
            .otherwise(F.lit(None).cast("boolean"))))
        return F.struct(name.alias("name"), is_group.alias("is_group"))

    return F.transform(anchors, to_struct)
