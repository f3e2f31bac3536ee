from quarry.sources.feeds import parse_feeds


def test_feed_links(spark):
    rss = ("<rss><channel><item><title>a</title><link>http://a/1</link></item>"
           "<item><title>no link</title></item></channel></rss>")
    atom = ("<feed xmlns=\"http://www.w3.org/2005/Atom\"><entry><link rel=\"alternate\" href=\"http://b/1\"/></entry>"
            "<entry><link href=\"http://b/2\"/></entry><entry><link rel=\"alternate\" href=\"http://b/3?x=1&amp;y=2\"/>"
            "</entry></feed>")
    feeds = spark.createDataFrame(
        [("rss", rss), ("atom", atom), ("bad", "<rss><channel><item><link>http://c"), ("empty", ""), ("none", None)],
        "feed_url string, payload string")
    got = {}
    for r in parse_feeds(feeds).collect():
        got.setdefault(r["feed_url"], []).append((r["pos"], r["url"]))
    assert got["rss"] == [(0, "http://a/1")]
    assert got["atom"] == [(0, "http://b/1"), (1, "http://b/2"), (2, "http://b/3?x=1&y=2")]
    assert "bad" not in got and "empty" not in got and "none" not in got


def test_items_beside_channel(spark):
    from quarry.sources.feeds import parse_feeds

    rdf = "<rdf><channel><title>t</title></channel><item><link>http://a/1</link></item><item><title>x</title></item><item><link>http://a/2</link></item></rdf>"
    df = spark.createDataFrame([("f", rdf)], "feed_url string, payload string")
    assert [(r.pos, r.url) for r in parse_feeds(df).orderBy("pos").collect()] == [(0, "http://a/1"), (1, "http://a/2")]


def links(spark, payload):
    df = spark.createDataFrame([("f", payload)], "feed_url string, payload string")
    return [r.url for r in parse_feeds(df).orderBy("pos").collect()]


def test_guid_stands_for_a_missing_link(spark):
    assert links(spark, "<rss><channel><item><guid>http://a/1</guid></item><item><guid isPermaLink='true'> http://a/2 </guid></item>"
                        "<item><guid isPermaLink='false'>id-3</guid></item><item><link>http://a/4</link><guid>http://a/x</guid></item>"
                        "<item><link/><guid>http://a/5</guid></item></channel></rss>") == ["http://a/1", "http://a/2", "http://a/4", "http://a/5"]


def test_prefixed_feeds(spark):
    atom = ("<?xml version='1.0'?><a:feed xmlns:a='http://www.w3.org/2005/Atom'><a:title>t</a:title><a:entry><a:link href='http://b/1'/>"
            "<a:link rel='self' href='http://b/x'/></a:entry><a:entry><a:title>none</a:title></a:entry><a:entry><a:link rel='alternate' href='http://b/2'/>"
            "</a:entry></a:feed>")
    assert links(spark, atom) == ["http://b/1", "http://b/2"]
    rdf = ("<rdf:RDF xmlns:rdf='http://www.w3.org/1999/02/22-rdf-syntax-ns#' xmlns='http://purl.org/rss/1.0/'><channel rdf:about='c'><title>t</title></channel>"
           "<item rdf:about='http://c/1'><title>x</title><link>http://c/1</link></item><item rdf:about='c2'><link>http://c/2</link></item></rdf:RDF>")
    assert links(spark, rdf) == ["http://c/1", "http://c/2"]
    named = rdf.replace("xmlns='http", "xmlns:r='http").replace("<channel", "<r:channel").replace("</channel", "</r:channel").replace("<item", "<r:item").replace(
        "</item", "</r:item").replace("<link", "<r:link").replace("</link", "</r:link")
    assert links(spark, named) == ["http://c/1", "http://c/2"]


def test_rss_of_all_versions(spark):
    old = "<rss version='0.91'><channel><item><title>a</title><link>http://d/1</link></item></channel></rss>"
    new = ("<rss version='2.0' xmlns:atom='http://www.w3.org/2005/Atom'><channel><atom:link rel='self' href='http://d/feed'/>"
           "<item><atom:link href='http://d/other'/><link>http://d/1</link></item><item><atom:link href='http://d/other'/></item></channel></rss>")
    assert links(spark, old) == links(spark, new) == ["http://d/1"]
