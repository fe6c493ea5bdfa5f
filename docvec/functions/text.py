"""Text clean-up and identity columns, all JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The entities decoded in page text. "&amp;" comes last so that
# "&amp;lt;" becomes "&lt;" and not "<".
HTML_ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&amp;", "&"),
]
TITLE_CHARS = 80


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_whitespace(text: Column | str) -> Column:
    """Collapse white space to one space and strip both edges.

    The edges lose every character up to U+0020, control characters included;
    Spark's ``trim`` would strip spaces only.
    """
    collapsed = F.regexp_replace(_col(text), r"\s+", " ")
    return F.regexp_replace(collapsed, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def has_visible(text: Column | str) -> Column:
    """Whether anything is left of a text once its white space is normalized."""
    return _col(text).rlike(r"[^\x00-\x20]")


def title_of(text: Column | str) -> Column:
    """The first 80 characters, up to a line terminator."""
    return F.regexp_extract(_col(text), "^(.{1,%d})" % TITLE_CHARS, 1)


def sha256_hex(c: Column | str) -> Column:
    return F.sha2(_col(c), 256)


def doc_id(uri: Column | str) -> Column:
    return sha256_hex(uri)


def chunk_id(doc: Column | str, offset: Column | str) -> Column:
    """Id of a chunk: its document and its ordinal there."""
    return sha256_hex(F.concat_ws(":", _col(doc), _col(offset).cast("string")))


def shard_of(doc: Column | str, num_shards: int) -> Column:
    """Shard of a document; all its chunks go to the same one."""
    if num_shards < 1:
        raise ValueError("num_shards must be at least 1")
    return F.abs(F.crc32(_col(doc))) % F.lit(num_shards).cast("bigint")


def looks_like_html(text: Column | str) -> Column:
    return _col(text).rlike(r"(?i)^\s*<(!doctype|html)")


def html_to_text(html: Column | str) -> Column:
    """Visible text of a page: no scripts, styles, comments or tags."""
    visible = F.regexp_replace(
        _col(html),
        r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->",
        " ",
    )
    text = F.regexp_replace(visible, r"<[^>]*>", " ")
    for entity, char in HTML_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return normalize_whitespace(F.coalesce(text, F.lit("")))
