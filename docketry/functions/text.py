"""Native text functions on page lines: cleaning, squashing, visibility, line sets."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def trimmed(text: Column) -> Column:
    """The text without white space at either end (Spark's ``trim`` knows only the space)."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def ascii_only(text: Column) -> Column:
    """The text without characters beyond ASCII; taken before changing case, so that all engines agree."""
    return F.regexp_replace(text, r"[^\x00-\x7F]+", "")


def squash_upper(text: Column) -> Column:
    """Upper-case letters and digits only."""
    return F.regexp_replace(F.upper(ascii_only(text)), r"[^A-Z0-9]+", "")


def squash_lower(text: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(ascii_only(text)), r"[^a-z0-9]+", "")


def letters_upper(text: Column) -> Column:
    """Upper-case letters only."""
    return F.regexp_replace(F.upper(ascii_only(text)), r"[^A-Z]+", "")


def panel_letters(text: Column) -> Column:
    """Upper-case letters with the marks that separate flags."""
    return F.regexp_replace(F.upper(ascii_only(text)), r"[^A-Z_,\[\]]+", "")


def loose_upper(text: Column) -> Column:
    """Upper case without spaces and apostrophes, other marks kept: what type patterns are matched on."""
    return F.translate(F.upper(text), " '", "")


def loose_letters(text: Column) -> Column:
    """``loose_upper`` letter for letter, as SQL engines change case, for patterns in ASCII.

    ``upper`` makes several letters of one, some of them in ASCII: SS of a sharp s, FI of a ligature.
    Beyond ASCII, just the dotless i and the long s have a single letter in ASCII; others stay as they are.
    """
    return F.translate(text, f"{ascii_lowercase}\u0131\u017f '", f"{ascii_uppercase}IS")


def first_contained(key: Column, options: Column, of: Callable[[Column], Column] = lambda option: option) -> Column:
    """The first of an array of options whose squashed text, ``of`` it, a squashed key holds; null where it holds none.

    The key is bound first: an expression inside the filter would be evaluated for every option.
    """
    first = lambda bound: F.get(F.filter(options, lambda option: F.contains(bound, of(option))), F.lit(0))
    return F.get(F.transform(F.array(key), first), F.lit(0))


def clean_lines(lines: Column) -> Column:
    """Lines without white space at the ends, blank lines and page boilerplate."""
    return F.filter(F.transform(lines, trimmed), lambda x: (x != "") & ~x.rlike(fixed.BOILERPLATE_PATTERN))


def all_lines(lines: Column, ocr_lines: Column, second_lines: Column) -> Column:
    """A page's lines, then what other readings of it add; duplicates inside ``lines`` stay."""
    lines, ocr, second = (F.coalesce(x, F.array().cast("array<string>")) for x in (lines, ocr_lines, second_lines))
    return F.concat(lines, F.array_except(F.array_distinct(F.concat(ocr, second)), lines))


def white_ink(color: Column) -> Column:
    """Whether a colour of one, three or four parts is white on paper; no colour is visible."""
    light = F.forall(color, lambda c: c >= 0.95)
    no_ink = F.forall(color, lambda c: c <= 0.05)
    return F.coalesce(F.when(F.size(color).isin(1, 3), light).when(F.size(color) == 4, no_ink), F.lit(False))


def hidden_char(char: Column, width: Column, height: Column) -> Column:
    """Whether a character of a page can't be seen: white, outside the page, or below 1.5 points."""
    outside = (char["x1"] < 0) | (char["x0"] > width) | (char["bottom"] < 0) | (char["top"] > height)
    return white_ink(char["color"]) | outside | (char["size"] < 1.5)


def split_visible(chars: Column, width: Column, height: Column) -> Column:
    """A struct of visible text, hidden text and the number of visible characters."""
    hidden = F.filter(chars, lambda c: hidden_char(c, width, height))
    visible = F.filter(chars, lambda c: ~hidden_char(c, width, height))
    text = lambda cs: F.array_join(F.transform(cs, lambda c: c["text"]), "")
    return F.struct(text(visible).alias("visible"), text(hidden).alias("hidden"), F.size(visible).alias("n_visible"))


#: Parts of a web page that a reader doesn't see.
HIDDEN_HTML = r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"


def html_hidden(html: Column) -> Column:
    """Scripts, styles and comments, joined."""
    return F.array_join(F.regexp_extract_all(html, F.lit(f"({HIDDEN_HTML})"), F.lit(1)), "")


def html_visible(html: Column) -> Column:
    """The page's text without tags and without hidden parts, spaces collapsed."""
    text = F.regexp_replace(F.regexp_replace(html, HIDDEN_HTML, " "), r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def needs_ocr(n_visible: Column, lines: Column) -> Column:
    """Whether a page's text layer is boilerplate alone, so that its raster must be read."""
    return (n_visible <= fixed.OCR_BELOW_CHARS) | (F.size(F.coalesce(lines, F.array().cast("array<string>"))) == 0)


def ordered_rows(boxes: Column) -> Column:
    """Texts of recognised boxes in reading order: by top, then left."""
    return F.transform(F.array_sort(F.transform(boxes, lambda b: F.struct(b["y"].alias("y"), b["x"].alias("x"), b["text"].alias("text")))), lambda b: b["text"])


def damage(ink: Column, grey: Column) -> Column:
    """How a scanned region reads: by its share of ink and of middle grey."""
    return F.when((ink < 0.002) & (grey < 0.01), "blank").when(grey > ink * 2.5, "blurred").otherwise("crisp")


def flags_in(text: Column, flags: tuple[str, ...] = fixed.FLAGS) -> Column:
    """Flags named in a text, sorted."""
    low = F.translate(F.lower(text), " ", "_")
    named = F.filter(F.array(*map(F.lit, flags)), lambda f: F.contains(low, f))
    return F.array_sort(F.array_distinct(named))


def flag_set(text: Column) -> Column:
    """The array of a ``|``-joined flag text: lower case, sorted, without ``none`` and empties."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(text), r"\|"), lambda f: (f != "") & (f != "none"))))


def duration(seconds: Column) -> Column:
    """A duration in hours, minutes and seconds."""
    s = F.greatest(seconds.cast("long"), F.lit(0))
    return F.when(s >= 3600, F.format_string("%dh%02dm", F.floor(s / 3600), F.floor(s % 3600 / 60))).when(
        s >= 60, F.format_string("%dm%02ds", F.floor(s / 60), s % 60)
    ).otherwise(F.format_string("%ds", s))


def bar(value: Column, most: Column, width: int = 20) -> Column:
    """A histogram bar of at most ``width`` marks."""
    return F.repeat(F.lit("#"), F.round(value / F.greatest(most, F.lit(1)) * width).cast("int"))
