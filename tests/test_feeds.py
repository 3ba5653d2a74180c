from pagewright.session import ship
from pagewright.sources import feeds

BASE = "https://www.a.example"
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" xmlns:dc="http://purl.org/dc/elements/1.1/"><title>x</title>
<entry><title type="html"> První </title><link rel="self" href="/s"/><link rel="alternate" href="/a#top"/><published>2024-01-01T10:00:00Z</published><summary>s</summary></entry>
<entry><link href="https://www.a.example/b"/><updated>2024-02-01</updated></entry><entry><title>bez odkazu</title></entry>
<entry><title>c</title><link href="/c"/><dc:date>2024-03-01</dc:date></entry></feed>"""
RSS = """<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:dcterms="http://purl.org/dc/terms/"><channel><title>x</title><script src="x"></script>
<item><title><![CDATA[Zpráva & další]]></title><link> https://www.a.example/1 </link><pubDate>Mon, 01 Jan 2024 10:00:00 +0100</pubDate><description>d</description></item>
<item><title>2</title><guid isPermaLink="true">https://www.a.example/2</guid><dc:date>2024-01-02</dc:date></item>
<item><title>3</title><guid>tag:3</guid><id>https://www.a.example/3</id><dcterms:modified>2024-01-03</dcterms:modified></item>
<item><title>4</title><guid>tag:4</guid></item><item><link>/5</link><createdDate>&lt;time datetime="2024-01-05T00:00:00"&gt;5. 1.&lt;/time&gt;</createdDate></item></channel></rss>"""
EVENTS = f"""<events><event><id>7</id><details><url>/akce/7</url></details><name><![CDATA[Ples]]></name><dates><date><start_date>5.2.2024</start_date><start_time>19:30</start_time></date></dates>
<organizer><name>Spolek</name></organizer><place><other>Sál</other></place><types><type>ples</type></types><description>{"x" * 600}</description></event>
<event><id>8</id><details><url> /akce/8#x </url></details></event><event><id>9</id></event></events>"""
RESPONSE = """<response><item><link/>https://www.a.example/r1<title>R1</title><published><![CDATA[<time datetime="2024-05-01">1. 5.</time>]]></published></item>
<item><link><![CDATA[https://www.a.example/r2]]></link><published>2024-06-01</published></item><item><link>none</link></item></response>"""
GENERIC = '<x><y href="/g1"/><y href="https://other.example/"/>viz https://www.a.example/g2 a https://www.a.example/g2</x>'


def test_feeds_of_other_writers(spark):
    ship(spark)
    rows = [("a", BASE, ATOM), ("r", BASE, RSS), ("e", BASE, EVENTS), ("c", BASE, RESPONSE), ("g", BASE, GENERIC), ("n", BASE, None), ("b", BASE, "<rss><channel><item>")]
    got = {}
    for r in feeds.feed_rows(spark.createDataFrame(rows, "feed string, base string, xml string")).collect():
        got.setdefault(r.feed, []).append((r.url.removeprefix(BASE), r.title, r.published, r.description))
    assert sorted(got["a"]) == [("/a", "První", "2024-01-01T10:00:00Z", "s"), ("/b", "No title", "2024-02-01", None), ("/c", "c", "2024-03-01", None)]
    assert sorted(got["r"]) == [("/1", "Zpráva & další", "Mon, 01 Jan 2024 10:00:00 +0100", "d"), ("/2", "2", "2024-01-02", None), ("/3", "3", "2024-01-03", None), ("/5", "No title", "2024-01-05T00:00:00", None)]
    assert sorted(got["e"]) == [("/akce/7", "Ples (5.2.2024 19:30)", "2024-02-05T19:30:00", f"Popis: {'x' * 500}... | Organizator: Spolek | Misto: Sál | Typ: ples"), ("/akce/8", "Event 8", None, None)]
    assert sorted(got["c"]) == [("/r1", "R1", "2024-05-01", None), ("/r2", "No title", "2024-06-01", None)]
    assert sorted(x[0] for x in got["g"]) == ["/g1", "/g2"] and set(got) == set("arecg")


def test_sitemap_indexes_are_followed(spark):
    ship(spark)
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    files = [
        ("r", f"<sitemapindex {ns}><sitemap><loc> a </loc></sitemap><sitemap><loc>b</loc></sitemap></sitemapindex>"),
        ("a", f"<urlset {ns}><url><loc>u1</loc><lastmod>1</lastmod></url><url><loc>u2</loc></url><url><loc>u1</loc></url></urlset>"),
        ("b", "<sitemapindex><sitemap><loc>c</loc></sitemap><sitemap><loc>r</loc></sitemap></sitemapindex>"),
        ("c", "<urlset><url><loc>u2</loc><lastmod>3</lastmod></url></urlset>"), ("d", "<urlset><url><loc>u9</loc></url></urlset>"),
    ]
    tree = feeds.sitemap_tree(spark.createDataFrame(files, "url string, xml string"), spark.createDataFrame([("r",)], "url string"))
    assert {tuple(r) for r in tree.collect()} == {("a", "u1", None), ("c", "u2", "3")}
