"""URL and file-name column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ustrip

# Site base for relative links, characters illegal in file names, name cap,
# and the content-type → extension rules (first match wins, defaults last).
BASE_URL = "https://www.bbc.com"
ILLEGAL_NAME_CHARS = '[\\\\/*?:"<>|]'
NAME_MAX_CHARS = 100
IMAGE_EXT_RULES = ((("jpeg", "jpg"), ".jpg"), (("png",), ".png"), (("gif",), ".gif"), (("webp",), ".webp"))
IMAGE_EXT_DEFAULT = ".jpg"
VIDEO_EXT_RULES = ((("mp4",), ".mp4"), (("webm",), ".webm"))
VIDEO_EXT_DEFAULT = ".mp4"


def absolutize(url: Column, base: str | Column = BASE_URL) -> Column:
    """``//host/x`` → ``https://host/x``; ``/x`` → base + ``/x``; anything else unchanged.

    ``base`` is a fixed site (the reference) or a column, e.g. the page's own scheme://host."""
    b = F.lit(base.rstrip("/")) if isinstance(base, str) else base
    return (F.when(url.startswith("//"), F.concat(F.lit("https:"), url))
            .when(url.startswith("/"), F.concat(b, url))
            .otherwise(url))


def media_extension(content_type: Column, kind: str = "image") -> Column:
    """File extension from a Content-Type header."""
    rules, default = (IMAGE_EXT_RULES, IMAGE_EXT_DEFAULT) if kind == "image" else (VIDEO_EXT_RULES, VIDEO_EXT_DEFAULT)
    ct = F.coalesce(content_type, F.lit(""))
    out = None
    for needles, ext in rules:
        cond = None
        for n in needles:
            c = F.instr(ct, n) > 0
            cond = c if cond is None else (cond | c)
        out = F.when(cond, ext) if out is None else out.when(cond, ext)
    return out.otherwise(default)


def article_filename(url: Column, title: Column, extension: str = ".txt") -> Column:
    """C11: illegal characters removed, stripped, cut at 100 characters; md5(url) if nothing is left."""
    cleaned = ustrip(F.regexp_replace(title, ILLEGAL_NAME_CHARS, ""))
    name = (F.when(title.isNull() | (title == "") | (cleaned == ""), F.md5(url))
            .otherwise(F.substring(cleaned, 1, NAME_MAX_CHARS)))
    return F.concat(name, F.lit(extension))


def media_filename(url: Column, extension: Column) -> Column:
    """C11 for media: md5 of the URL plus the extension."""
    return F.concat(F.md5(url), extension)


def loader_title(file_name: Column) -> Column:
    """The loader's title is the file name with every ``.txt`` removed."""
    return F.replace(file_name, F.lit(".txt"), F.lit(""))
