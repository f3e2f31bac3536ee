"""Crawl side: feed list (S2), feed parsing (S3), attaching fetched pages
(S4), flattening (S5).

The network fetch itself is not built (a single-machine client); fetched
bodies are the ``pages`` table, joined by url. Feeds are parsed with the
built-in ``from_xml``: one schema reads both RSS (channel/item/link) and
Atom (entry/link@href), and malformed XML gives null, so a bad feed yields
no links instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ITEM = "item:array<struct<link:string,guid:struct<_VALUE:string,_isPermaLink:string>>>"
FEED_SCHEMA = (f"channel struct<{_ITEM}>, {_ITEM.replace(':', ' ', 1)}, "
               "entry array<struct<link:array<struct<_href:string,_rel:string>>>>")
# The names of feeds' root elements, and the namespaces of RSS elements.
ROOTS = ("feed", "rss", "RDF")
RSS_SPACES = ("http://purl.org/rss/1.0/", "http://my.netscape.com/rdf/simple/0.9/", "http://channel.netscape.com/rdf/simple/0.9/",
              "http://backend.userland.com/rss", "http://backend.userland.com/rss2")
FEED_BLOCK = 50
WS = r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def read_feed_list(spark, path: str) -> DataFrame:
    """One feed url per line, stripped; blank lines are dropped (they
    would give no links). ``line`` keeps the file order within a file."""
    raw = spark.read.text(path)
    return (raw.select(F.regexp_replace("value", f"^{WS}+|{WS}+$", "").alias("feed_url"))
            .filter(F.col("feed_url") != ""))


def plain_names(payload: Column) -> Column:
    """The payload with the feed's own elements named without a prefix: that of the root element, and the one bound to an RSS
    namespace. Other vocabularies keep theirs, so an ``atom:link`` within an RSS item is not taken for its link."""
    name = r"[A-Za-z_][\w.\-]*"
    root = F.regexp_extract(payload, rf"<(?:({name}):)?(?:{'|'.join(ROOTS)})[\s>/]", 1)
    spaces = "|".join(x.replace(".", r"\.") for x in RSS_SPACES)
    rss = F.regexp_extract(payload, rf"xmlns:({name})\s*=\s*[\"'](?:{spaces})[\"']", 1)
    for prefix in (root, rss):
        payload = F.when(prefix == "", payload).otherwise(
            F.regexp_replace(payload, F.concat(F.lit(r"(</?)\Q"), prefix, F.lit(r"\E:")), F.lit("$1")))
    return payload


def parse_feeds(feeds: DataFrame) -> DataFrame:
    """S3 + S5: feeds(feed_url, payload) -> (feed_url, pos, url), the entry
    links of each feed in order; entries without a link are skipped, a
    malformed or empty payload gives no rows. An RSS item without a link has its ``guid`` for one, unless that says it
    is no permalink. For Atom the 'alternate' (or
    unlabelled) link of an entry is taken."""
    payload = feeds.select("feed_url", F.coalesce("payload", F.lit("")).alias("payload"))
    parsed = payload.select("feed_url", F.from_xml(plain_names(F.col("payload")), FEED_SCHEMA).alias("f"))

    def filled(text):
        return F.when(F.trim(text) != "", F.trim(text))

    def item_link(i):
        guid = F.when(F.coalesce(F.lower(i["guid"]["_isPermaLink"]), F.lit("true")) != "false", i["guid"]["_VALUE"])
        return F.coalesce(filled(i["link"]), filled(guid))

    # items stand in the channel, or beside it
    inside, beside = (F.transform(F.coalesce(F.col(c), F.array()), item_link) for c in ("f.channel.item", "f.item"))
    rss = F.concat(inside, beside)
    atom = F.transform(
        F.coalesce(F.col("f.entry"), F.array()),
        lambda e: F.try_element_at(
            F.filter(F.coalesce(e["link"], F.array()), lambda l: l["_rel"].isNull() | (l["_rel"] == "alternate")),
            F.lit(1))["_href"])
    links = F.filter(F.concat(rss, atom), lambda x: x.isNotNull() & (F.trim(x) != ""))
    return parsed.select("feed_url", F.posexplode(links).alias("pos", "url")).withColumn(
        "pos", F.col("pos").cast("bigint"))


def attach_pages(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Every link keeps its row; a page not fetched gives "" (the
    reference's failed fetch). Pages are made unique on url first so the
    join cannot multiply links: the one with the largest page_id counts,
    without such a column the largest body."""
    wanted = pages.join(links.select("url").distinct(), "url", "left_semi")
    body = F.max_by("html", "page_id") if "page_id" in pages.columns else F.max("html")
    bodies = wanted.groupBy("url").agg(body.alias("html"))
    return links.join(bodies, "url", "left").select(
        "feed_url", "pos", "url", F.coalesce("html", F.lit("")).alias("html"))


# ---------------------------------------------------------------- derived feeds
# Feeds built from the pages table (the driver data has no feeds): one feed
# per (host, block of FEED_BLOCK page ids), RSS or Atom by host, every other Atom feed with
# prefixed names; every seventh page is listed without a link, half of these (by id) with a
# guid that is one, in RSS; every fifth also links to a page
# that was never fetched; each host also lists one truncated feed.

def _host(url):
    return F.regexp_extract(url, r"://([^/#?]+)", 1)


def _xml_escape(c):
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def feed_items(pages: DataFrame) -> DataFrame:
    """(feed_url, atom, page_id, kind, link, guid): kind 0 = the page, 1 = a link
    to a missing page; link null = an entry without a link, which has a guid."""
    p = pages.select("page_id", "url", _host(F.col("url")).alias("host"))
    base = p.select(
        F.concat(F.lit("https://"), F.col("host"), F.lit("/feed/"), (F.col("page_id") / FEED_BLOCK).cast("bigint").cast("string")).alias("feed_url"),
        (F.length("host") % 2 == 1).alias("atom"),
        "page_id",
        F.lit(0).alias("kind"),
        F.when(F.col("page_id") % 7 != 3, F.col("url")).alias("link"),
        F.when(F.col("page_id") % 7 == 3, F.col("url")).alias("guid"))
    gone = base.filter(F.col("page_id") % 5 == 0).join(p.select("page_id", "url"), "page_id").select(
        "feed_url", "atom", "page_id", F.lit(1).alias("kind"), F.concat("url", F.lit("-gone")).alias("link"),
        F.lit(None).cast("string").alias("guid"))
    return base.unionByName(gone)


def feed_payloads(pages: DataFrame) -> DataFrame:
    """(feed_url, payload) XML documents, plus one truncated feed per host."""
    items = feed_items(pages)
    rss_item = F.when(F.col("link").isNotNull(),
                      F.concat(F.lit("<item><title>t</title><link>"), _xml_escape(F.col("link")), F.lit("</link></item>"))
                      ).otherwise(F.concat(F.lit("<item><title>no link</title><guid"), F.when(F.col("page_id") % 14 == 3, F.lit(""))
                                           .otherwise(F.lit(" isPermaLink=\"false\"")), F.lit(">"), _xml_escape(F.col("guid")), F.lit("</guid></item>")))
    prefix = F.when((F.col("page_id") / FEED_BLOCK).cast("bigint") % 2 == 1, F.lit("a:")).otherwise(F.lit(""))
    atom_item = F.when(F.col("link").isNotNull(),
                       F.concat(F.lit("<"), prefix, F.lit("entry><"), prefix, F.lit("title>t</"), prefix, F.lit("title><"), prefix,
                                F.lit("link rel=\"alternate\" href=\""), _xml_escape(F.col("link")), F.lit("\"/></"), prefix, F.lit("entry>"))
                       ).otherwise(F.concat(F.lit("<"), prefix, F.lit("entry><"), prefix, F.lit("title>no link</"), prefix, F.lit("title></"),
                                            prefix, F.lit("entry>")))
    x = items.select("feed_url", "atom", prefix.alias("prefix"), F.struct(
        "page_id", "kind", F.when(F.col("atom"), atom_item).otherwise(rss_item).alias("x")).alias("s"))
    grouped = x.groupBy("feed_url", "atom", "prefix").agg(F.sort_array(F.collect_list("s")).alias("s"))
    body = F.array_join(F.col("s.x"), "")
    good = grouped.select("feed_url", F.when(
        F.col("atom"), F.concat(F.lit("<"), "prefix", F.lit("feed xmlns"), F.when(F.col("prefix") == "", "").otherwise(":a"),
                                F.lit("=\"http://www.w3.org/2005/Atom\">"), body, F.lit("</"), "prefix", F.lit("feed>"))
    ).otherwise(F.concat(F.lit("<rss version=\"2.0\"><channel>"), body, F.lit("</channel></rss>"))).alias("payload"))
    broken = pages.select(F.concat(F.lit("https://"), _host(F.col("url")), F.lit("/feed/broken")).alias("feed_url")).distinct() \
        .select("feed_url", F.lit("<rss><channel><item><link>http://x").alias("payload"))
    return good.unionByName(broken)


def write_feed_list(pages: DataFrame, path: str) -> None:
    """A feed-list text file derived from the pages: every feed url, some
    with surrounding whitespace, and blank lines."""
    feeds = feed_payloads(pages).select("feed_url")
    lines = feeds.select(F.when(F.length("feed_url") % 3 == 0, F.concat(F.lit("  "), "feed_url", F.lit("\t")))
                         .otherwise(F.col("feed_url")).alias("value"))
    blanks = feeds.limit(3).select(F.lit("   ").alias("value"))
    lines.unionByName(blanks).write.mode("overwrite").text(path)
