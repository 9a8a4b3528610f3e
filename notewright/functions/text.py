"""String functions, Column to Column, all inside the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fold_pairs() -> tuple[str, str]:
    """Letters of the Latin, Greek and Cyrillic blocks and beyond whose compatibility decomposition, without marks, is one letter or digit of ASCII."""
    a, b = [], []
    for i in range(0x80, 0x10000):
        c = chr(i)
        d = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(d) == 1 and d.isascii() and d.isalnum():
            a.append(c)
            b.append(d)
    return "".join(a), "".join(b)


_FROM, _TO = _fold_pairs()


def fold(x: Column) -> Column:
    """``x`` without accents: letters that decompose into one ASCII letter become it, combining marks vanish."""
    return F.translate(F.regexp_replace(x, r"\p{M}+", ""), _FROM, _TO)


def _trim_dashes(x: Column) -> Column:
    return F.regexp_replace(x, "^-+|-+$", "")


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def slugify(x: Column, longest: int = 80) -> Column:
    """Lower-case ASCII letters and digits joined by '-'; null is ''."""
    s = _trim_dashes(F.regexp_replace(F.lower(fold(F.coalesce(x, F.lit("")))), "[^a-z0-9]+", "-"))
    return _trim_dashes(F.left(s, F.lit(longest)))


def slug_ascii(x: Column) -> Column:
    """As ``slugify`` of any length, but letters without an ASCII form are dropped, not turned into '-'."""
    s = F.regexp_replace(fold(F.coalesce(x, F.lit(""))), r"[^\x00-\x7F]", "")
    return _trim_dashes(F.lower(F.regexp_replace(s, "[^a-zA-Z0-9]+", "-")))


#: Articles that do not count at the start of a name. Fixed values.
ARTICLES = ("le", "la", "les", "l", "un", "une", "des", "du", "de", "the", "a", "an")


def canon(x: Column) -> Column:
    """The key that a name is compared by: its slug without leading articles; may be ''."""
    s = _trim_dashes(F.regexp_replace(F.lower(fold(F.coalesce(x, F.lit("")))), "[^a-z0-9]+", "-"))
    return F.regexp_replace(s, rf"^(?:(?:{'|'.join(ARTICLES)})(?:-|$))+", "")


def safe_name(x: Column) -> Column:
    """A file name: no reserved signs, no outer blanks or dots, single blanks; 'sans-nom' where nothing is left."""
    s = F.regexp_replace(strip(F.regexp_replace(x, r'[/\\:*?"<>|]', "-")), r"^\.+|\.+$", "")
    s = strip(F.regexp_replace(s, r"(?U)\s+", " "))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("sans-nom"))


def yaml_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit("'")), F.lit('"'))), ", "), F.lit("]"))


def yaml_quote(x: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def paragraph_key(x: Column) -> Column:
    """What paragraphs are compared by: single blanks, no outer ones, lower case."""
    return F.lower(strip(F.regexp_replace(x, r"(?U)\s+", " ")))


def lines_of(x: Column) -> Column:
    """The lines of a text that are not empty."""
    return F.filter(F.split(x, "\n"), lambda y: y != "")


def table_cell(x: Column) -> Column:
    """Fit for a cell of a Markdown table."""
    return F.replace(F.replace(x, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


#: Words that French running text has. Fixed values.
FRENCH_WORDS = ("le", "la", "les", "des", "une", "est", "qui", "dans", "pour", "avec", "sur", "par")


def looks_french(body: Column) -> Column:
    """At least three of the common words stand between blanks."""
    low = F.lower(body)
    return sum((F.contains(low, F.lit(f" {w} ")).cast("int") for w in FRENCH_WORDS), F.lit(0)) >= 3


WIKILINK = r"\[\[([^\]\[|\n`]{1,120})(?:\|[^\]\n]*)?\]\]"


def wikilinks(text: Column) -> Column:
    """Targets of the wikilinks of a text, in order, with repeats, trimmed."""
    return F.transform(F.regexp_extract_all(text, F.lit(WIKILINK), F.lit(1)), strip)


def strip_code(text: Column) -> Column:
    """Fenced code as many line ends as it has, indented code as empty lines, inline code as nothing: line numbers stay."""
    fence = r"(?sm)^[ \t]*(?:```|~~~).*?^[ \t]*(?:```|~~~)[ \t]*$"
    outside = F.split(text, fence, -1)
    inside = F.transform(F.regexp_extract_all(text, F.lit(fence), F.lit(0)), lambda x: F.regexp_replace(x, "[^\n]", ""))
    t = F.array_join(F.zip_with(outside, inside, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.regexp_replace(F.regexp_replace(t, r"(?m)^(?: {4}|\t).*$", ""), r"`[^`\n]*`", "")


def replace_tokens(text: Column, pattern: str, by) -> Column:  # noqa: ANN001
    """``text`` with each match of ``pattern`` (one group) replaced by ``by(group)``, which may look things up."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), by)
    return F.array_join(F.zip_with(F.split(text, pattern, -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


TOKEN = r"\{\{E:([^}]+)\}\}"


def resolve_tokens(text: Column, names: Column, promoted: Column) -> Column:
    """Entity tokens become links to promoted pages, else the bare name, else the slug in words. ``names``: map of slug to name; ``promoted``: array of slugs."""

    def one(token: Column) -> Column:
        k = canon(token)
        name = F.try_element_at(names, k)
        return F.when(name.isNotNull() & F.array_contains(promoted, k), F.concat(F.lit("[["), name, F.lit("]]"))).otherwise(F.coalesce(name, F.replace(token, F.lit("-"), F.lit(" "))))

    return replace_tokens(text, TOKEN, one)


def front_matter(text: Column, *, strict: bool = False) -> Column:
    """struct(fm MAP<STRING,STRING>, body, err, first_line): flat front matter between '---' lines, ':' or '=' after the key, list items joined to the key before,
    the last of repeated keys; err is 'absent', 'open' or 'line', then fm is null. ``strict``: only a line of its own closes it, and only ':' follows a key; the map's keys are
    in the order of their first lines."""
    lines = F.split(text, "\n", -1)
    at = F.transform(lines, lambda x, i: F.when((i > 0) & ((strip(x) == "---") | (F.endswith(strip(x), F.lit(" ---")) & F.lit(not strict))), i))
    end = F.array_min(F.filter(at, lambda i: i.isNotNull()))
    glued = strip(F.get(lines, end)) != "---"
    head = F.concat(F.slice(lines, F.lit(2), F.greatest(end - 1, F.lit(0))), F.when(glued, F.array(F.regexp_replace(F.get(lines, end), r"\s*---\s*$", ""))).otherwise(F.array().cast("array<string>")))
    rest = F.array_join(F.slice(lines, end + 2, F.greatest(F.size(lines) - end - 1, F.lit(0))), "\n")
    bare = lambda v: F.regexp_replace(strip(v), "^[\"']+|[\"']+$", "")
    used = F.filter(head, lambda x: (strip(x) != "") & ~F.startswith(strip(x), F.lit("#")))
    item = lambda x: x.rlike(r"^[ \t]") | F.startswith(strip(x), F.lit("-"))
    colon = lambda x: F.contains(x, F.lit(":"))
    part = lambda x, i: F.when(colon(x), F.regexp_extract(x, r"^([^:]*):(.*)$", i)).otherwise(F.regexp_extract(x, r"^([^=]*)=(.*)$", i))
    bad = F.exists(used, lambda x: ~item(x) & ~F.contains(x, F.lit(":")) & ~(F.contains(x, F.lit("=")) & F.lit(not strict)))
    # Fold the lines into (key, value) pairs; an item goes to the pair before it.
    pair = "struct<k:string,v:string>"
    start = F.array().cast(f"array<{pair}>")

    def step(acc: Column, x: Column) -> Column:
        new = F.struct(strip(part(x, 1)).alias("k"), bare(part(x, 2)).alias("v"))
        last = F.try_element_at(acc, F.lit(-1))
        more = bare(F.regexp_replace(strip(x), "^-+", ""))
        joined = F.struct(last.k.alias("k"), F.when(last.v == "", more).otherwise(F.concat_ws(", ", last.v, more)).alias("v"))
        return F.when(~item(x), F.concat(acc, F.array(new))).when((F.size(acc) > 0) & (more != ""), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))).otherwise(acc)

    pairs = F.aggregate(used, start, step)
    last = lambda ps, k: F.element_at(F.filter(ps, lambda p: p.k == k), F.lit(-1)).v
    # The pairs are an item of an array here: an expression inside a lambda would be worked out anew for each key.
    made = F.transform(F.array(pairs), lambda ps: F.map_from_arrays(F.array_distinct(F.transform(ps, lambda p: p.k)), F.transform(F.array_distinct(F.transform(ps, lambda p: p.k)), lambda k: last(ps, k))))
    fm = F.get(made, F.lit(0))
    err = F.when(~F.startswith(text, F.lit("---")), F.lit("absent")).when(end.isNull(), F.lit("open")).when(bad, F.lit("line"))
    return F.struct(F.when(err.isNull(), fm).alias("fm"), F.when(F.coalesce(err, F.lit("")).isin("absent", "open"), text).otherwise(rest).alias("body"), err.alias("err"), F.when(err.isNull() | (err == "line"), end + 1).alias("fm_lines"))


def fm_block(text: Column) -> Column:
    """The raw front matter between the '---' lines at the start, or ''."""
    return F.regexp_extract(text, r"(?s)\A---\s*\n(.*?)\n---\s*\n", 1)


def fm_get(block: Column, key: str) -> Column:
    """The value of the first line of that key in a raw front matter."""
    return strip(F.regexp_extract(block, rf"(?m)^{key}:\s*(.*)$", 1))


def fm_list(block: Column, key: str) -> Column:
    """The value as a list: of '[a, \"b\"]' its items, else the one value."""
    bare = lambda x: F.regexp_replace(strip(x), "^[\"']+|[\"']+$", "")
    v = fm_get(block, key)
    inner = F.when(v.rlike(r"^\[.*\]$"), F.split(F.regexp_extract(v, r"^\[(.*)\]$", 1), ",")).otherwise(F.array(v))
    return F.filter(F.transform(inner, bare), lambda x: x != "")


def upsert_between(text: Column, block: Column, begin: str, end: str) -> Column:
    """What stands from the first ``begin`` to the first ``end`` mark is replaced by ``block``; without both it is added after an empty line."""
    b, e = F.lit(begin), F.lit(end)
    tail = F.substring(text, F.instr(text, end) + len(end), F.length(text))
    replaced = F.concat(F.substring_index(text, begin, 1), F.regexp_replace(block, r"\n+$", ""), tail)
    return F.when(F.contains(text, b) & F.contains(text, e), replaced).otherwise(F.concat(F.regexp_replace(text, r"\n+$", ""), F.lit("\n\n"), block))


def first_prose_line(body: Column) -> Column:
    """The first line that is no heading, quotation, list, comment or table, to 160 characters; null without one."""
    lines = F.filter(F.transform(F.split(body, "\n"), strip), lambda x: (x != "") & ~x.rlike(r"^(?:#|>|-|<!--|\||\*)"))
    return F.left(F.try_element_at(lines, F.lit(1)), F.lit(160))


def source_rel(path: Column) -> Column:
    """A path from its first 'raw/' folder on."""
    return F.regexp_replace(path, "^.*?/(raw/)", "$1")


def stem_of(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")


def bare_stem(stem: Column) -> Column:
    """A stem without a leading date and a trailing short hash."""
    return F.regexp_replace(stem, r"^\d{4}-\d{2}-\d{2}[-_]|[-_][0-9a-f]{8}$", "")


#: Words of a slug that tell nothing of what it names. Fixed values.
SLUG_STOP = (
    "a au aux avec ce ces dans de des du elle en et eux il je la le les leur lui ma mais me meme mes moi mon ne nos notre nous on ou par pas pour qu que qui sa se "
    "ses son sur ta te tes toi ton tu un une vos votre vous c d j l m n s t y est sont etre the of to and for is"
).split()


def slug_parts(slug: Column) -> Column:
    """The telling words of a slug, with repeats."""
    return F.filter(F.split(slug, "-"), lambda x: (x != "") & ~x.isin(SLUG_STOP))


def stub_kind(name: Column) -> Column:
    """Folder for a page that only links name: proper names, acronyms, products and addresses are entities, all else concepts."""
    words = F.filter(F.split(name, r"(?U)\s+"), lambda w: w != "")
    upper = name.rlike(r"(?U)\p{Lu}") & ~name.rlike(r"(?U)\p{Ll}")
    return F.when(name.rlike(r"(?U)\d|\."), F.lit("entities")).when((F.size(words) <= 3) & F.exists(words, lambda w: w.rlike(r"(?U)^\p{Lu}")), F.lit("entities")).when(upper, F.lit("entities")).otherwise(F.lit("concepts"))


#: Secrets and what replaces them, in this order. Fixed values.
SECRETS = (
    (r"(bot)?[0-9]{8,10}:AA[A-Za-z0-9_-]{30,}", "<REDACTED_TG_TOKEN>"),
    (r"(?i)(Bearer|Authorization:)\s*[A-Za-z0-9._~+/=-]{16,}", "$1 <REDACTED>"),
    (r"(ya29\.|AIza|AQ\.|sk-|ghp_|gho_|xox[baprs]-)[A-Za-z0-9._~+/=-]{10,}", "<REDACTED_KEY>"),
    (r"(?i)(password|passwd|secret|token|api[_-]?key)(\s*[:=]\s*)[^\s,;]+", "$1$2<REDACTED>"),
)


def redact(text: Column) -> Column:
    for pattern, by in SECRETS:
        text = F.regexp_replace(text, pattern, by)
    return text


def first_bytes(text: Column, n: int) -> Column:
    """At most ``n`` bytes of UTF-8; a character cut by the limit is replaced."""
    return F.make_valid_utf8(F.substring(F.encode(text, "UTF-8"), 1, n).cast("string"))


#: Signs of notifications by code. Fixed values.
SIGNS = {"OK": "✅", "QUOTA": "⏳", "STOP": "🛑", "RESUME": "🔁", "LINT": "📋"}


def sign(code: Column) -> Column:
    out = F.lit("📥")
    for k, v in SIGNS.items():
        out = F.when(code == k, F.lit(v)).otherwise(out)
    return out


def blank_lines_with(text: Column, title: Column) -> Column:
    """``text`` with the lines emptied that contain the title in any case."""
    low = F.lower(title)
    return F.when(F.coalesce(title, F.lit("")) == "", text).otherwise(F.array_join(F.transform(F.split(text, "\n", -1), lambda x: F.when(F.contains(F.lower(x), low), F.lit("")).otherwise(x)), "\n"))


def line_of(text: Column, position: Column) -> Column:
    """Number of the line, from 1, of a 1-based position in a text."""
    before = F.substring(text, F.lit(1), position - 1)
    return F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1


def spool_path(sha: Column, idx: Column, root: str = "") -> Column:
    return F.concat_ws("/", F.lit(root), F.left(sha, F.lit(2)), F.concat(sha, F.lit("."), idx.cast("string"), F.lit(".json")))


#: Signs in an output that a quota was hit. Fixed values.
QUOTA_SIGNS = (
    r"(?i)RESOURCE_EXHAUSTED|Resource has been exhausted|\"code\"\s*:\s*429|HTTP/[0-9.]+ 429|Too Many Requests|quota reached|quota exceeded|"
    r"exceeded your current quota|quotaMetric|QuotaFailure|RetryInfo|retryDelay|rate.?limit[ _-]?(exceeded|reached)|usage limit reached"
)


def quota_hit(text: Column) -> Column:
    return text.rlike(QUOTA_SIGNS)
