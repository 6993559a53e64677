"""Links of directory listing pages."""

from pyspark.sql import functions as F

# Parts of a page whose text is not markup.
NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"

# The href of an anchor: quoted either way, or bare.
ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def listing_links(pages, html="html", directories_only=True):
    """One row per link of each page, as ``href``.

    By default only links to directories, which end in a slash.
    """
    markup = F.regexp_replace(html, NOT_MARKUP, "")
    links = F.explode(F.regexp_extract_all(markup, F.lit(ANCHOR), F.lit(1)))
    kept = [name for name in pages.columns if name != html]
    quoted = F.col("_link").rlike("^[\"']")
    inner = F.expr("substring(_link, 2, length(_link) - 2)")
    href = F.when(quoted, inner).otherwise(F.col("_link"))
    found = pages.select(*kept, links.alias("_link")).select(
        *kept, F.replace(href, F.lit("&amp;"), F.lit("&")).alias("href")
    )
    return found.filter(F.col("href").endswith("/") if directories_only else F.col("href") != "")
