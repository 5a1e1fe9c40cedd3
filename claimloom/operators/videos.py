"""Videos and embeds: provider urls in canonical form, bucketed and deduplicated, all as Columns.

A page's candidate urls are attribute values found by pattern inside generated code; only publishers whose videos stand in a
scope parse the page first to cut that scope out. What a publisher's page yields, in which form and order, is its ``VideoSpec``.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import data as D
from claimloom.functions import text as T
from claimloom.functions.resolve import sanitize_provider_url
from claimloom.functions.url import b64_text, strip_query, unquoted, with_scheme
from claimloom.html.dom import Element, parse

#: The forms in which providers' players are embedded.
YOUTUBE = r"(?i)https?://(?:www\.)?(?:youtube\.com|youtube-nocookie\.com)/embed/([A-Za-z0-9_-]{6,})"
YOUTUBE_WATCH = r"(?i)https?://(?:www\.)?youtube\.com/watch\?v=([A-Za-z0-9_-]{6,})"
DAILYMOTION = r"(?i)https?://(?:www\.)?dailymotion\.com/(?:embed/)?video/([A-Za-z0-9]+)"
DAILYMOTION_PLAYER = r"(?i)https?://(?:geo\.)?dailymotion\.com/player/[^\"'>?]+(?:\?[^\"'>#]*)?\bvideo=([A-Za-z0-9]+)"
FACEBOOK = r"(?i)(https?://(?:www\.)?facebook\.com/[^\"'>]+/videos/[0-9]+)"
FACEBOOK_PLUGIN = r"(?i)https?://(?:www\.)?facebook\.com/plugins/video\.php\?[^\"'>]+"
TIKTOK = r"(?i)https?://(?:www\.)?tiktok\.com/(@[^/\"']+/video/[0-9]+)"
TIKTOK_EMBED = r"(?i)https?://(?:www\.)?tiktok\.com/embed/(?:v2/)?([0-9]+)"
TWEET = r"(?i)https?://platform\.twitter\.com/embed/Tweet\.html\?[^\"'>]*?\bid=([0-9]+)"
TWEET_FRAME = r"(?i)platform\.twitter\.com/embed/Tweet\.html"
#: Words of a key that speaks of a video.
VIDEO_KEY = "video|hls|player|mixed[_-]?media"
STATUS = r"(?i)https?://(?:www\.|mobile\.)?(?:twitter|x)\.com/[^/\"']+/(?:web/)?status/([0-9]+)"
ULTIMEDIA = r"(?i)((?:https?:)?//(?:www\.)?ultimedia\.com/deliver/generic/iframe/[^\"'\s]+)"
RAW = r"(?i)(https?://[^\"'>\s]+\.(?:mp4|m3u8)(?:\?[^\"'>\s]*)?)"
INSTAGRAM = r"(?i)(https?://(?:www\.)?instagram\.com/(?:reel|p)/[A-Za-z0-9_-]+/?)"


def _id(col: Column, *patterns: str) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(col, p, 1), F.lit("")) for p in patterns])


def youtube(col: Column, form: str = "autoplay", watch: bool = True) -> Column:
    """V1: canonical url, null for others. ``form``: autoplay, embed or watch."""
    found = _id(with_scheme(col), YOUTUBE, *([YOUTUBE_WATCH] if watch else []))
    head, tail = {"autoplay": ("https://www.youtube.com/embed/", "?autoplay=1"), "embed": ("https://www.youtube.com/embed/", ""), "watch": ("https://www.youtube.com/watch?v=", "")}[form]
    return F.concat(F.lit(head), found, F.lit(tail))


def dailymotion(col: Column) -> Column:
    """V5."""
    return F.concat(F.lit("https://www.dailymotion.com/embed/video/"), _id(with_scheme(col), DAILYMOTION_PLAYER, DAILYMOTION))


def facebook(col: Column) -> Column:
    """V3, V4: the video's own url, also out of a plugin's ``href``."""
    url = with_scheme(col)
    href = F.nullif(F.regexp_extract(url, "[?&]href=([^&#]*)", 1), F.lit(""))
    decoded = F.coalesce(unquoted(href), href)
    inner = F.coalesce(_id(decoded, FACEBOOK), decoded, url)
    return F.coalesce(strip_query(_id(url, FACEBOOK)), F.when(url.rlike(FACEBOOK_PLUGIN), strip_query(inner)))


def facebook_plugin(col: Column) -> Column:
    """V3: the plugin's own url, as publishers that do not look into it give it."""
    return _id(with_scheme(col), f"({FACEBOOK_PLUGIN})".replace("((?i)", "(?i)("))


def with_autoplay(col: Column) -> Column:
    """A url with ``autoplay=1`` in its query, in place where it is there already."""
    bare, fragment = F.regexp_replace(col, "#.*$", ""), F.regexp_extract(col, "(#.*)$", 1)
    put = F.when(bare.rlike("[?&]autoplay="), F.regexp_replace(bare, "([?&]autoplay=)[^&]*", "$11")).when(bare.contains("?"), F.concat(bare, F.lit("&autoplay=1"))).otherwise(F.concat(bare, F.lit("?autoplay=1")))
    return F.concat(put, fragment)


def tiktok(col: Column) -> Column:
    """V6."""
    url = with_scheme(col)
    return F.coalesce(F.concat(F.lit("https://www.tiktok.com/"), _id(url, TIKTOK)), F.concat(F.lit("https://www.tiktok.com/embed/v2/"), _id(url, TIKTOK_EMBED)))


def tweet_id(col: Column) -> Column:
    return _id(with_scheme(col), TWEET, STATUS, r"data-tweet-id=[\"']([0-9]+)")


def tweet(col: Column, head: str = "https://x.com/i/web/status/", links: bool = True) -> Column:
    """V7; some publishers use ``https://twitter.com/i/web/status/``, and some count embedded tweets alone, no ``links``."""
    return F.concat(F.lit(head), tweet_id(col) if links else _id(with_scheme(col), TWEET))


def ultimedia(col: Column) -> Column:
    """V9."""
    return strip_query(with_scheme(_id(col, ULTIMEDIA)))


def raw_video(col: Column) -> Column:
    """A stream or file."""
    return strip_query(_id(with_scheme(col), RAW))


def instagram(col: Column) -> Column:
    """I20."""
    return _id(with_scheme(col), INSTAGRAM)


#: Canonicalisers in order; the first that knows a url names its bucket.
PROVIDERS = [("youtube", youtube), ("dailymotion", dailymotion), ("facebook", facebook), ("ultimedia", ultimedia), ("tiktok", tiktok), ("twitter", tweet), ("instagram", instagram), ("raw_video", raw_video)]


def provider(col: Column, providers=PROVIDERS) -> Column:
    """Struct (provider, url) of a candidate, null for others."""
    out = F.lit(None).cast("struct<provider:string,url:string>")
    for name, canonical in reversed(providers):
        url = canonical(col)
        out = F.when(url.isNotNull(), F.struct(F.lit(name).alias("provider"), url.alias("url"))).otherwise(out)
    return out


def page_urls(html: Column) -> Column:
    """Candidate urls of a page: attributes (facades, lazy and consent-blocked frames too), srcdoc, raw streams."""
    attributes = T.attribute_urls(html, "src|href|data-src|data-src-cmplz|data-facadesrc|cite|data-video-url|data-stream-url")
    documents = F.transform(T.attribute_urls(html, "srcdoc"), T.unescape_basic)
    inner = F.flatten(F.transform(documents, lambda d: T.attribute_urls(d)))
    streams = F.regexp_extract_all(T.unescape_basic(html), F.lit(RAW), F.lit(1))
    tweets = F.transform(T.attribute_urls(html, "data-tweet-id"), lambda i: F.concat(F.lit("https://platform.twitter.com/embed/Tweet.html?id="), i))
    return F.concat(tweets, F.transform(attributes, T.unescape_basic), inner, streams)


def frame_urls(html: Column) -> Column:
    """Urls that a page frames: iframes' sources and what stands in their ``srcdoc``."""
    tags = F.regexp_extract_all(T.text_or_empty(html), F.lit("(?is)<iframe\\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"), F.lit(0))
    sources = F.transform(F.flatten(F.transform(tags, lambda t: T.attribute_urls(t, "src"))), T.unescape_basic)
    documents = F.transform(F.flatten(F.transform(tags, lambda t: T.attribute_urls(t, "srcdoc"))), T.unescape_basic)
    return F.concat(sources, F.flatten(F.transform(documents, text_urls)))


def text_urls(html: Column) -> Column:
    """Urls of the players of YouTube and Dailymotion anywhere in a page's text, scripts too."""
    return F.regexp_extract_all(T.unescape_basic(html), F.lit("(?i)((?:https?:)?//[a-z.]*(?:youtube|youtube-nocookie|dailymotion)\\.com/[^\"'<>\\s]+)"), F.lit(1))


def video_tweets(html: Column, head: str = "https://x.com/") -> Column:
    """V7, V8: urls of the embedded tweets that show a video, under their owners.

    A frame whose url has a document of features that can be read shows one if a key of it says so; of other frames the title has to. The
    owner is the first name (``@...``) among the document's values.
    """
    tags = F.regexp_extract_all(T.text_or_empty(html), F.lit("(?is)<iframe\\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"), F.lit(0))
    attribute = lambda t, name: F.get(T.attribute_urls(t, name), F.lit(0))

    def of(tag: Column) -> Column:
        src = T.unescape_basic(attribute(tag, "src"))
        number = F.coalesce(_id(src, TWEET), F.when(src.rlike(TWEET_FRAME), attribute(tag, "data-tweet-id")))
        stated = b64_text(F.nullif(F.regexp_extract(src, "[?&]features=([^&#]*)", 1), F.lit("")))
        features = F.when(F.to_json(F.try_parse_json(stated)).rlike("^\\{.*[^{}]"), stated)
        owner = F.nullif(F.regexp_extract(features, '[:\\[,]\\s*"@+([^"@]+)"', 1), F.lit(""))
        shows = F.when(features.isNotNull(), D.has_key_like(features, VIDEO_KEY)).otherwise(F.lower(F.coalesce(attribute(tag, "title"), F.lit(""))).contains("video"))
        return F.when(shows & number.rlike("^[0-9]{5,}$"), F.concat(F.lit(head), F.coalesce(owner, F.lit("i/web")), F.lit("/status/"), number))

    return F.array_distinct(F.filter(F.transform(tags, of), lambda u: u.isNotNull()))


#: Urls that no canonicaliser can know lack all of these.
MAYBE = "(?i)youtu|dailymotion|facebook|ultimedia|tiktok|twitter|x\\.com|instagram|\\.mp4|\\.m3u8"


def known(urls: Column, providers=PROVIDERS) -> Column:
    """(provider, url) of the urls that some canonicaliser knows."""
    return F.filter(F.transform(F.filter(urls, lambda u: u.rlike(MAYBE)), lambda u: provider(u, providers)), lambda p: p.isNotNull())


def buckets(found: Column, providers=PROVIDERS) -> Column:
    """``known`` urls as a map provider -> shortest prefixes; empty buckets are left out.

    ``found`` is read once for each provider: give it as a column of its own, not as an expression.
    """
    entries = F.array(*[F.struct(F.lit(n).alias("key"), T.shortest_prefixes(F.transform(F.filter(found, _named(n)), lambda p: p.url)).alias("value")) for n, _ in providers])
    return F.map_from_entries(F.filter(entries, lambda e: F.size(e.value) > 0))


def _named(name: str):
    return lambda p: p.provider == name


def video_list(found: Column) -> Column:
    """Buckets flattened into one sorted list."""
    return F.array_sort(F.array_distinct(F.flatten(F.map_values(found))))


def poster(video_id: Column) -> Column:
    """V19."""
    return F.concat(F.lit("https://img.youtube.com/vi/"), video_id, F.lit("/hqdefault.jpg"))


def anchor(embed: Column) -> Column:
    """A linked poster for an embed of YouTube, null for others."""
    video = _id(embed, YOUTUBE)
    return F.concat(F.lit('<a href="https://www.youtube.com/embed/'), video, F.lit('?autoplay=1"><img src="'), poster(video), F.lit('" alt=""><span>▶</span></a>'))


def href_from_anchor(col: Column) -> Column:
    """The first link of an anchor."""
    return F.nullif(F.regexp_extract(col, 'href="([^"]+)"', 1), F.lit(""))


def is_visible(width: Column, height: Column, displayed: Column, least: int = 40) -> Column:
    """V16, over captured layout; unknown layout passes."""
    return F.coalesce(displayed, F.lit(True)) & (F.coalesce(width, F.lit(least)) >= least) & (F.coalesce(height, F.lit(least)) >= least)


def tweet_has_video(features: Column, iframe_title: Column) -> Column:
    """V8: a decoded feature document with a player's key, else a title that says video."""
    return D.has_key_like(features) | F.lower(F.coalesce(iframe_title, F.lit(""))).contains("video")


@dataclass(frozen=True)
class VideoSpec:
    """What one publisher's pages yield.

    ``providers``: buckets, in order (V15); ``youtube``: form of its urls (V1), also from ``watch`` urls; ``tweets``: head of tweets'
    urls (V7), also of links to them (``links``); ``plugin``: Facebook's plugin urls stay as they are (V3); ``scope``: where embeds stand (V17), for the providers
    ``scoped`` or for all; ``whole``: the page is read where the scope holds nothing (V18); ``own``: the publisher's player (V11-V13)
    or tweets that show a video (V8), and ``own_scope`` where they stand; ``framed``: providers whose embeds count where they are framed,
    and anywhere in the page only if none is (V18); ``order``: one sorted list, buckets one after the other, or as the page has them;
    ``queries``: Ultimedia's and raw urls keep theirs; ``sane``: urls of ``scoped`` are rid of what names no item before they are compared (U10).
    """

    publisher: str
    providers: tuple[str, ...]
    youtube: str = "autoplay"
    watch: bool = False
    tweets: str = "https://x.com/i/web/status/"
    links: bool = True
    plugin: bool = False
    scope: str = ""
    scoped: tuple[str, ...] = ()
    whole: bool = False
    own: str = ""
    own_scope: str = ""
    framed: tuple[str, ...] = ()
    order: str = "sorted"
    queries: bool = False
    sane: bool = False

    def selectors(self) -> tuple[str, str]:
        return self.scope, self.own_scope


_DEFACTO = ("youtube", "dailymotion", "ultimedia", "raw_video")
_SOCIAL = "div[class*='EmbedInstagram__Wrapper']"
ANY = VideoSpec("any", tuple(n for n, _ in PROVIDERS), watch=True)
#: Scopes and forms of each publisher.
SPECS = {
    s.publisher: s
    for s in [
        VideoSpec("br", ("youtube", "facebook"), "watch", plugin=True, own="ard", own_scope="section[class*='ArticleModuleMedia_wrapper']", order="buckets"),
        VideoSpec("rtl", ("youtube", "facebook"), "watch", plugin=True, scope="main", own="rtl", own_scope="main", order="buckets"),
        VideoSpec("stern", (), own="renditions"),
        VideoSpec("volksverpetzer", ("youtube", "facebook"), "watch", plugin=True, order="buckets"),
        VideoSpec("factencheckafp", ("youtube", "twitter"), watch=True, tweets="https://twitter.com/i/web/status/", links=False, order="page"),
        VideoSpec("20minutes", ("youtube", "ultimedia", "instagram", "tiktok"), scope=_SOCIAL, scoped=("instagram",), own="tweets", own_scope="div.twitter-tweet", framed=("youtube",), queries=True, sane=True),
        VideoSpec("defactobservatoire", _DEFACTO, watch=True, scope="div.defacto-fact-check-body", queries=True),
        VideoSpec("factuelafp", _DEFACTO, watch=True, scope="div#block-factuel-content div.g2web", queries=True),
        VideoSpec("fasocheck", ("youtube", "dailymotion", "facebook", "ultimedia", "raw_video"), watch=True),
        VideoSpec("francetvinfo", ("youtube", "dailymotion", "tiktok", "twitter", "raw_video"), links=False, scope="div.page-content-wrapper"),
        VideoSpec("lemonde", ("youtube", "dailymotion"), "embed", framed=("youtube", "dailymotion")),
        VideoSpec("liberation", ("youtube", "twitter"), order="buckets"),
        VideoSpec("numerama", ("youtube", "tiktok")),
        VideoSpec("tf1info", ("youtube", "instagram", "tiktok", "twitter", "facebook", "raw_video"), scope=_SOCIAL, scoped=("instagram", "tiktok", "twitter", "facebook", "raw_video"), sane=True),
    ]
}
#: Hosts of advertising.
ADVERTS = ("emsservice.de", "adsserver", "adserver", "doubleclick", "googlesyndication", "outbrain", "outbrainimg", "taboola")


def canonicals(spec: VideoSpec, names: tuple[str, ...]) -> list:
    """The spec's canonicalisers of these providers, as ``provider`` takes them."""
    own = {
        "youtube": lambda c: youtube(c, spec.youtube, spec.watch), "twitter": lambda c: tweet(c, spec.tweets, spec.links), "facebook": facebook_plugin if spec.plugin else facebook,
        "ultimedia": (lambda c: with_scheme(_id(c, ULTIMEDIA))) if spec.queries else ultimedia, "raw_video": (lambda c: _id(with_scheme(c), RAW)) if spec.queries else raw_video,
    }
    return [(n, own.get(n, of)) for n, of in PROVIDERS if n in names]


def scoped_html(html: Column, *selectors: str) -> Column:
    """Struct (error, h0, h1, ...): outer HTML of the elements that each selector finds, empty without any; one parse a page.

    A page that cannot be read has the reason in ``error`` (R8), not an end of the job.
    """
    names = [f"h{k}" for k in range(len(selectors))]

    @F.pandas_udf("struct<" + ",".join(f"{n}:string" for n in ["error", *names]) + ">")
    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_scopes(p, selectors) for p in pages], columns=["error", *names])

    return run(html)


def _scopes(page: str | Element | None, selectors: tuple[str, ...]) -> list[str | None]:
    try:
        root = parse(page) if page is None or isinstance(page, str) else page
        return [None, *["".join(e.html() for e in _outermost(root, s)) if s else "" for s in selectors]]
    except Exception as error:
        return [f"{type(error).__name__}: {error}", *["" for _ in selectors]]


def _outermost(root: Element, selector: str) -> list[Element]:
    """Elements found that do not stand in another one found."""
    found = root.select(selector)
    inside = {id(e) for e in found}
    return [e for e in found if not any(id(a) in inside for a in e.ancestors())]


def listed(spec: VideoSpec, whole: Column, scoped: Column, own: Column, logs: Column | None = None) -> Column:
    """A page's videos by its publisher's spec. ``scoped`` and ``own`` are the HTML of the spec's two scopes."""
    region = whole if not spec.scope else F.coalesce(F.nullif(scoped, F.lit("")), whole) if spec.whole else scoped
    inside = spec.providers if spec.scope and not spec.scoped else spec.scoped
    groups = [(names, html) for names, html in ((tuple(n for n in spec.providers if n not in inside), whole), (tuple(inside), region)) if names]
    urls_of: dict[str, Column] = {}
    for k, (names, html) in enumerate(groups):
        of = canonicals(spec, names)
        urls_of[f"found{k}"] = known(page_urls(html), of)
        if set(names) & set(spec.framed):
            urls_of |= {f"framed{k}": known(frame_urls(html), of), f"anywhere{k}": known(F.concat(page_urls(html), text_urls(html)), of)}
    if not groups:
        return _in_order(spec, {}, whole, own, logs)

    def taken(read: Column) -> Column:
        lists = {}
        urls = lambda kind, n: F.transform(F.filter(read[kind], _named(n)), lambda p: p.url)
        for k, (names, _) in enumerate(groups):
            lists |= {n: F.when(F.size(urls(f"framed{k}", n)) > 0, urls(f"framed{k}", n)).otherwise(urls(f"anywhere{k}", n)) if n in spec.framed else urls(f"found{k}", n) for n in names}
        return _in_order(spec, lists, whole, own, logs)

    # a page's urls are looked for once, not once for each provider
    return T.bound(F.struct(*[urls.alias(name) for name, urls in urls_of.items()]), taken)


def _in_order(spec: VideoSpec, lists: dict[str, Column], whole: Column, own: Column, logs: Column | None) -> Column:
    """The urls of each provider and the publisher's own, as its spec orders them."""
    none = F.array().cast("array<string>")
    native = {"ard": lambda: ard_streams(whole, own), "rtl": lambda: native_streams(page_urls(own)), "tweets": lambda: video_tweets(own), "renditions": lambda: F.filter(F.array(first_rendition(whole, logs)), lambda u: u.isNotNull()), "": lambda: none}[spec.own]()
    if spec.own == "rtl":
        lists = {n: F.filter(v, lambda u: ~_is_advert(u)) for n, v in lists.items()}
    if spec.sane:
        lists = {n: F.transform(v, sanitize_provider_url) if n in spec.scoped else v for n, v in lists.items()}
    if spec.order == "page":
        return F.array_distinct(F.concat(*lists.values(), native))
    buckets_ = [T.shortest_prefixes(v) for v in lists.values()]
    if spec.order == "sorted":
        return F.array_sort(F.array_distinct(F.concat(none, native, *buckets_)))
    first, last = (native, none) if spec.own == "rtl" else (none, native)
    return F.concat(first, *[F.array_sort(b) for b in buckets_], last)


def of_pages(pages: DataFrame, key: str = "url", publisher: str | None = None) -> DataFrame:
    """(key, videos, error): urls of each page's (key, html, and optionally log_urls) videos; pages are parsed only for a scope."""
    spec = SPECS.get(publisher or "", ANY)
    logs = F.col("log_urls") if "log_urls" in pages.columns else None
    scoped = scoped_html(F.col("html"), *spec.selectors()) if any(spec.selectors()) else F.struct(F.lit(None).cast("string").alias("error"), F.lit("").alias("h0"), F.lit("").alias("h1"))
    cut = pages.select("*", scoped.alias("__s"))
    return cut.select(key, listed(spec, F.col("html"), F.col("__s.h0"), F.col("__s.h1"), logs).alias("videos"), F.col("__s.error").alias("error"))


def _is_advert(url: Column) -> Column:
    return F.lower(url).rlike("|".join(a.replace(".", "\\.") for a in ADVERTS))


def native_streams(urls: Column, host: str = "rtl.de") -> Column:
    """A broadcaster's own streams, sorted; of those that name one item (``world-`` and 20 hexadecimal digits or more) one stays:
    the first, given up for a progressive one if it is none, or for an mp4 if it is none. Others follow; advertising goes."""
    own = F.filter(urls, lambda u: u.rlike("(?i)^https?://[^\"'<>\\s]*\\." + host.replace(".", "\\.") + "/") & ~u.startswith("blob:") & ~_is_advert(u))
    sorted_ = F.array_sort(F.array_distinct(own))
    item = lambda u: F.regexp_extract(u, "world-([a-f0-9]{20,})-", 1)
    items = F.array_distinct(F.filter(F.transform(sorted_, item), lambda i: i != ""))

    def better(held: Column, u: Column) -> Column:
        progressive = u.contains("progressive") & ~held.contains("progressive")
        return F.when(held.isNull() | progressive | (u.endswith(".mp4") & ~held.endswith(".mp4")), u).otherwise(held)

    best = F.transform(items, lambda i: F.aggregate(F.filter(sorted_, lambda u: item(u) == i), F.lit(None).cast("string"), better))
    return F.concat(F.array_sort(best), F.filter(sorted_, lambda u: item(u) == ""))


def ard_streams(html: Column, player: Column) -> Column:
    """JSON-LD videos and the player's documents of a page, and files in the player's section; a sorted set."""
    blocks = F.regexp_extract_all(T.text_or_empty(html), F.lit("(?is)<script[^>]*type=[\"']application/ld\\+json[\"'][^>]*>(.*?)</script>"), F.lit(1))
    stated = F.flatten(F.transform(blocks, lambda b: D.video_objects(T.unescape_basic(b))))
    streams = F.flatten(F.transform(T.attribute_urls(html, "data-mediajson"), lambda d: D.player_streams(T.unescape_basic(d))))
    tags = F.regexp_extract_all(T.text_or_empty(player), F.lit("(?is)<(?:video|source)\\b[^>]*>"), F.lit(0))
    files = F.filter(F.flatten(F.transform(tags, lambda t: T.attribute_urls(t, "src"))), lambda u: ~u.startswith("blob:"))
    every = F.transform(F.concat(F.coalesce(stated, F.array().cast("array<string>")), F.coalesce(streams, F.array().cast("array<string>")), files), lambda u: F.trim(u))
    return F.array_sort(F.array_distinct(F.filter(every, lambda u: u.isNotNull() & (u != ""))))


def first_rendition(html: Column, log_urls: Column | None = None) -> Column:
    """The first progressive rendition that the page states, else the first mp4 that the captured network log shows."""
    stated = F.transform(T.attribute_urls(html, "data-renditions"), lambda r: D.value_at(T.unescape_basic(r), "$.progressive.url"))
    first = F.get(F.filter(stated, lambda u: u.isNotNull() & (u != "")), F.lit(0))
    return first if log_urls is None else F.coalesce(first, F.get(F.filter(log_urls, lambda u: F.lower(u).endswith(".mp4")), F.lit(0)))


def first_stream(renditions: Column, html: Column, log_urls: Column) -> Column:
    """A progressive rendition, else a file in the page, else the first one the captured network log shows."""
    logged = F.get(F.filter(log_urls, lambda u: strip_query(F.lower(u)).endswith(".mp4")), F.lit(0))
    return F.coalesce(D.progressive_url(renditions), F.nullif(F.regexp_extract(T.text_or_empty(html), r"(?i)(https?://[^\"'>\s]+\.mp4)", 1), F.lit("")), logged)


def embeds(html: Column) -> Column:
    """Distinct social embeds of a page as (platform, url, iframe_src)."""
    frames = F.transform(T.attribute_urls(html, "src|data-src|data-v|cite"), T.unescape_basic)
    social = [p for p in PROVIDERS if p[0] in ("instagram", "twitter", "facebook", "tiktok", "youtube")]
    found = F.transform(frames, lambda u: F.struct(provider(u, social).alias("p"), u.alias("src")))
    return F.array_distinct(F.transform(F.filter(found, lambda x: x.p.isNotNull()), lambda x: F.struct(x.p.provider.alias("platform"), x.p.url.alias("url"), x.src.alias("iframe_src"))))
