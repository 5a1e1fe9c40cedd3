"""Pages of each publisher's shape with what has to come out of them, for the queries that hold extraction against SQL.

``{n}`` stands for a page's number on both sides, so every page of a table makes its own. Expected values follow the rules of the
publishers' specs, written out by hand; none is taken from the engine's output.
"""

from __future__ import annotations


def p(k: int) -> str:
    return f"Paragraph {k} of page {{n}} holds a sentence, with commas, and is long enough to count as content of the article."


BODY = "".join(f"<p>{p(k)}</p>" for k in range(1, 5))
TEXT = "\n".join(p(k) for k in range(1, 5))
HEAD, TITLE = "<title>A headline of page {n} | Site</title>", "A headline of page {n}"


def page(body: str, head: str = "") -> str:
    return f"<html><head>{HEAD}{head}</head><body><nav><a href='/x'>menu</a></nav>{body}<footer><p>foot</p></footer></body></html>"


def article(inner: str) -> str:
    return page(f"<article><h1>Head {{n}}</h1><div class='text'>{inner}</div></article>")


_APA = "Wenn Sie zum Faktencheck-Team Kontakt aufnehmen oder Faktenchecks zu relevanten Themen anregen möchten, schreiben Sie bitte an faktencheck@apa.at"
_TF1 = "VOUS SOUHAITEZ nous poser des questions ou nous soumettre une information qui ne vous parait pas fiable ? N'hésitez pas à nous écrire à l'adresse lesverificateurs@tf1.fr. Retrouvez-nous également sur X : notre équipe y est présente derrière le compte @verif_TF1LCI."
_LD = '<script type="application/ld+json">{"@graph": [{"@type": "WebPage", "name": "w"}, {"@type": ["NewsArticle"], "headline": "Headline {n}", "articleBody": "' + " ".join(p(k) for k in range(1, 6)) + '"}]}</script>'
_PLAIN = article(BODY + "<p>Passend dazu: mehr</p><p>gone {n}</p>")
#: spec: (static page, rendered page or "", title, content).
ARTICLES: dict[str, tuple[str, str, str, str]] = {
    **dict.fromkeys(["de/rtl", "de/tagesschau", "de/volksverpetzer", "de/wdr", "fr/20minutes", "fr/francetvinfo"], (_PLAIN, "", TITLE, TEXT)),
    **dict.fromkeys(["de/apa", "de/br"], (article(f"{BODY}<p>Wir prüfen. {_APA}.</p><p>gone {{n}}</p>"), "", TITLE, f"{TEXT}\nWir prüfen.")),
    **dict.fromkeys(["de/dpa", "de/presseportal", "fr/dpa"], (page(f"<p class='teaser'>The teaser of {{n}}</p><article><div class='text'>{BODY}</div></article>"), "", TITLE, f"The teaser of {{n}}\n{TEXT}")),
    "de/correctiv": (
        page(f"<h1>Head {{n}}</h1><div class='detail__content'>{BODY}<figure><img src='/i.jpg'><figcaption>Figure {{n}}</figcaption></figure><aside><p>aside</p></aside><p>Mehr von CORRECTIV</p><p>a teaser</p><p>Weiterlesen</p><p>The end {{n}}</p><p>Newsletter bestellen</p><p>gone</p></div>"),
        "", "Head {n}", f"{TEXT}\nFigure {{n}}\nThe end {{n}}",
    ),
    **dict.fromkeys(["de/factencheckafp", "fr/factuelafp"], (page(f"<article><h1>h</h1><p>short</p></article><div class='x mentions-copyright'>c</div><article>{BODY}</article>", _LD), "", "Headline {n}", " ".join(p(k) for k in range(1, 6)))),
    "de/stern": (article(f"{BODY}<p>Zum Schluss {{n}}. Weiterer  Faktencheck dazu</p><p>gone</p>"), "", TITLE, f"{TEXT}\nZum Schluss {{n}}."),
    "fr/defactobservatoire": (page(f"<div class='defacto-fact-check-chapeau'>The  lead of {{n}}</div><article><div class='text'>{BODY}</div></article>"), "", TITLE, f"The lead of {{n}}\n{TEXT}"),
    "fr/lemonde": (page(f"<div class='ds-description'><span class='ds-chapo'>The chapo of {{n}}</span> more</div><article><div class='text'>{BODY}</div></article>"), "", TITLE, f"The chapo of {{n}}\n{TEXT}"),
    "fr/liberation": (article("<p>Too short {n}</p>"), article(BODY), TITLE, TEXT),
    "fr/numerama": (article(f"{BODY}<div class='box js-Newsletter'><p>sign up</p></div><p>{p(9)}</p>"), "", TITLE, TEXT),
    "fr/sciencefeedback": (
        page(f"<main><h1>Claim {{n}}</h1>{BODY}<ul><li>A point</li></ul><figure><figcaption>Figure {{n}}</figcaption></figure></main><footer class=\"wp-block-group margin-block-start-xl\"><p>gone</p></footer>"),
        "", "Claim {n}", f"Claim {{n}}\n{TEXT}\nA point\nFigure {{n}}",
    ),
    "fr/tf1info": (article(f"{BODY}<p>{_TF1}</p><p>gone</p>"), "", TITLE, TEXT),
    "fr/fasocheck": (
        page(f"<h1 class='entry-title'>Entry {{n}}</h1><div class='entry-content'>{BODY}<script>var x = 1;</script><div class='sfsi_widget'>share</div><p>gone</p></div>"), "", "Entry {n}", TEXT,
    ),
    "fr/observalgerie": (
        page(f"<h1 class='entry-title'>Entry {{n}}</h1><div class='entry-content'><p>{p(1)}</p><a class='related-article'><p>related</p></a><figcaption>f</figcaption><p>{p(2)}</p><div class='component'>c</div><p>gone</p></div>"),
        "", "Entry {n}", f"{p(1)}\n{p(2)}",
    ),
}

#: What a guarded site shows in place of its article.
DENIED = page("<h1>Access Denied</h1><p>Request blocked, verify you are human. " + "Reference number of the request that was stopped. " * 8 + "</p>")
_LD_TEXT = " ".join(p(k) for k in range(1, 6))
_STATIC_LD = _LD.replace("Headline", "Static")
_ESCAPED_LD = _LD.replace('{"@graph"', "{&quot;@graph&quot;").replace('"headline": "', "&quot;headline&quot;: &quot;").replace('", "articleBody": "', "&quot;, &quot;articleBody&quot;: &quot;").replace('"}]}</script>', "&quot;}]}</script>").replace('[{"@type": "WebPage", "name": "w"}, {"@type": ["NewsArticle"], ', "[{&quot;@type&quot;: [&quot;NewsArticle&quot;], ")
_BROKEN_LD = '<script type="application/ld+json">{"@type": "NewsArticle", "articleBody": </script>'
_DOM = page(f"<article><h1>Head {{n}}</h1>{BODY}</article>", _BROKEN_LD)
#: Arms of the cascades beyond the first: (spec, url, static page, rendered page, title, content, error); "" for none.
ARMS: list[tuple[str, str, str, str, str, str, str]] = [
    ("de/factencheckafp", "https://faktencheck.afp.com/a", DENIED, page("", _LD), "Headline {n}", _LD_TEXT, ""),  # blocked, then rendered
    ("fr/factuelafp", "https://factuel.afp.com/a", DENIED, page("", _LD), "Headline {n}", _LD_TEXT, ""),
    ("fr/factuelafp", "https://factuel.afp.com/a", DENIED, "", "", "", "PermissionError: access denied"),
    ("fr/factuelafp", "https://factuel.afp.com/a", DENIED, DENIED, "", "", "PermissionError: access denied"),
    ("de/factencheckafp", "https://faktencheck.afp.com/a", page("", _STATIC_LD), page("", _LD), "Headline {n}", _LD_TEXT, ""),  # rendered first
    ("de/factencheckafp", "https://faktencheck.afp.com/a", page("", _STATIC_LD), DENIED, "Static {n}", _LD_TEXT, ""),
    ("fr/factuelafp", "https://factuel.afp.com/a", page("", _STATIC_LD), page("", _LD), "Static {n}", _LD_TEXT, ""),  # static first
    ("fr/factuelafp", "https://factuel.afp.com/a", page("", _ESCAPED_LD), "", "Headline {n}", _LD_TEXT, ""),  # entities in JSON-LD
    ("fr/factuelafp", "https://factuel.afp.com/a", _DOM, "", "Head {n}", TEXT, ""),  # malformed JSON-LD, then the container
    ("fr/liberation", "https://www.liberation.fr/a", article(BODY), article(BODY + BODY), TITLE, f"{TEXT}\n{TEXT}", ""),  # under 800 on its own host
    ("fr/liberation", "https://other.example/a", article(BODY), article(BODY + BODY), TITLE, TEXT, ""),
    ("de/dpa", "https://dpa.example/a", page(f"<p class='teaser'>{p(2)}</p><article><div class='text'>{BODY}</div></article>"), "", TITLE, TEXT, ""),  # a lead that the body has
    ("fr/fasocheck", "https://fasocheck.org/a", page(f"<article><h1>Head {{n}}</h1>{BODY}</article>"), "", "Head {n}", f"Head {{n}}\n{TEXT}", ""),  # the second container
    ("fr/observalgerie", "https://observalgerie.com/a", page(f"<h1>Head {{n}}</h1><div class='text'>{BODY}</div>"), "", "Head {n}", "", ""),  # no container, no other way
    ("de/correctiv", "https://correctiv.org/a", article(BODY + "<p>Newsletter</p>"), "", TITLE, TEXT, ""),  # no container, then by score
    ("de/rtl", "https://rtl.de/a", article(BODY + "<ul><li><p>An item {n}</p></li></ul>"), "", TITLE, f"{TEXT}\nAn item {{n}}\nAn item {{n}}", ""),  # nested tags repeat
    ("de/rtl", "https://rtl.de/a", "", article(BODY), TITLE, TEXT, ""),  # the rendered copy alone
    ("de/rtl", "https://rtl.de/a", "", "", "", "", "no page captured"),
]

H = "https://host.example"


def fig(name: str, caption: str, cls: str = "", more: str = "") -> str:
    """A figure with a small rendition, a large one in its srcset, and a caption."""
    return f"<figure class='{cls}'><img src='/{name}-{{n}}-300x200.jpg' srcset='/{name}-{{n}}-300x200.jpg 300w, /{name}-{{n}}-900x600.jpg 900w'>{more}<figcaption>{caption}</figcaption></figure>"


def large(name: str) -> str:
    return f"{H}/{name}-{{n}}-900x600.jpg"


def small(name: str) -> str:
    return f"{H}/{name}-{{n}}-300x200.jpg"


_TWO = fig("a", "First  of {n}") + fig("b", "Second of {n}")
_OUT = "<aside>" + fig("z", "Beside") + "</aside>"
#: publisher: (page, images as (url, caption) in order). With ``url`` as the mode, both renditions stay.
IMAGES: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "br": (
        page("<section class='ArticleModuleText'><figure><img src='/a-{n}.jpg?w=300' srcset='/a-{n}.jpg?w=300 300w, /a-{n}.jpg?w=900 900w'><p class='Image_caption'>First {n}</p><span class='Image_copyright'>Holder</span></figure></section><header>" + fig("z", "Head") + "</header>" + fig("b", "Second {n}")),
        [(f"{H}/a-{{n}}.jpg?w=900", "First {n} © Holder"), (large("b"), "Second {n}")],
    ),
    "correctiv": (page(f"<article>{_TWO}{fig('c', 'first of {n}')}</article>" + _OUT), [(large("a"), "First of {n}"), (large("b"), "Second of {n}")]),
    "factencheckafp": (
        page("<div class='wrapper-image'><img src='/sites/styles/s/public/a-{n}.jpg' srcset='/sites/styles/l/public/a-{n}.jpg 900w'><span class='legend'>One {n}</span></div><div class='wrapper-image'><img src='/sites/styles/s/public/b-{n}.jpg'></div><div class='wrapper-image'><img src='/sites/styles/s/public/c-{n}.jpg'></div>"),
        [(f"{H}/sites/styles/l/public/a-{{n}}.jpg", "One {n}"), (f"{H}/sites/styles/s/public/b-{{n}}.jpg", "")],
    ),
    "rtl": (page(f"<main><article>{_TWO}</article><div class='default_root__x'></div>{fig('c', 'Later')}</main>"), [(large("a"), "First of {n}"), (large("b"), "Second of {n}")]),
    "stern": (
        page("<article class='article'><figure><img src='/t/x/v3/w300/r1.5/-/a-{n}.jpg' srcset='/t/x/v3/w300/r1.5/-/a-{n}.jpg 300w, /t/x/v3/w900/r1.5/-/a-{n}.jpg 900w'><figcaption>One {n}</figcaption></figure><div class='teaser'>" + fig("z", "Teaser") + "</div><img src='/t/x/v3/w300/r1/-/c-{n}.jpg'><img src='/t/x/v3/w300/r1/-/d-{n}.jpg'></article>"),
        [(f"{H}/t/x/v3/w900/r1.5/-/a-{{n}}.jpg", "One {n}"), (f"{H}/t/x/v3/w300/r1/-/c-{{n}}.jpg", "")],
    ),
    "tagesschau": (
        page("<article><div class='absatzbild'><img src='/image/11111111-2222-3333-4444-00000000000{n}/x.webp?width=256' srcset='/image/11111111-2222-3333-4444-000000000001/x-{n}.jpg?width=256 256w, /image/11111111-2222-3333-4444-000000000001/x-{n}.jpg?width=1024 1024w'><div class='absatzbild__info'><p class='absatzbild__info__text'>One {n}</p></div></div><div class='teaser'><div class='absatzbild'><img src='/t.jpg'></div></div></article>"),
        [(f"{H}/image/11111111-2222-3333-4444-000000000001/x-{{n}}.jpg?width=1024", "One {n}")],
    ),
    "volksverpetzer": (
        page("<div id='article_body_content'><figure class='wp-block-image'><img src='/t/x/v3/w300/-/a-{n}.jpg' srcset='/t/x/v3/w900/-/a-{n}.jpg 900w'><figcaption>First {n}</figcaption></figure><img src='/b-{n}.png' alt='Second {n}'><img src='/c-{n}.png' alt='The Logo'><article class='teaser'><img src='/t.jpg'></article></div>"),
        [(f"{H}/t/x/v3/w900/-/a-{{n}}.jpg", "First {n}"), (f"{H}/b-{{n}}.png", "Second {n}")],
    ),
    "20minutes": (page(f"<article class='o-paper__content'>{fig('a', 'First {n}', 'c-media')}</article>{fig('z', 'Out', 'c-media')}"), [(small("a"), "First {n}")]),
    "defactobservatoire": (
        page(f"<div class='defacto-fact-check-body'>{fig('a', 'First {n}')}<div class='ww-item image'><p><img src='/b-{{n}}.png'><span class='the legend'>Second {{n}}</span></p></div></div>{fig('z', 'Out')}"),
        [(small("a"), "First {n}"), (f"{H}/b-{{n}}.png", "Second {n}")],
    ),
    "factuelafp": (
        page("<div id='block-factuel-content'><div class='wrapper-image'><img src='/a-{n}.jpg'><span class='legend'>One {n}</span></div><div class='wrapper-image'><img src='/b-{n}.webp'></div></div>"), [(f"{H}/a-{{n}}.jpg", "One {n}")],
    ),
    "fasocheck": (
        page("<div class='entry-content'><div class='wp-caption'><img src='/a-{n}.jpg'><p class='wp-caption-text'>One {n}</p></div><img src='/b-{n}.jpg' alt='Two {n}'><div class='sfsi_wicon'><img src='/s.png'></div></div>"),
        [(f"{H}/a-{{n}}.jpg", "One {n}"), (f"{H}/b-{{n}}.jpg", "Two {n}")],
    ),
    "francetvinfo": (
        page("<div class='c-body'><figure><img src='/a/fit-in/300x/{n}.jpg' srcset='/a/fit-in/300x/{n}.jpg 300w, /a/fit-in/900x/{n}.jpg 900w'><figcaption>One {n}</figcaption></figure><figure><iframe src='https://platform.twitter.com/embed/Tweet.html?id=12345'></iframe><figcaption>A tweet</figcaption></figure></div>" + fig("z", "Out")),
        [(f"{H}/a/fit-in/900x/{{n}}.jpg", "One {n}"), ("tweet:12345", "A tweet")],
    ),
    "lemonde": (page("<article class='article__content'>" + "<figure><picture><source srcset='/a-{n}-400w.jpg 400w, /a-{n}-1200w.jpg 1200w'><img src='/a-{n}-800w.jpg'></picture><figcaption class='article__legend'>One {n}</figcaption></figure></article>" + fig("z", "Out")), [(f"{H}/a-{{n}}-1200w.jpg", "One {n}")]),
    "liberation": (page("<article><div class='article-body'><figure><img src='/a/fit-in/300x/{n}.jpg' srcset='/b/fit-in/900x/{n}.jpg 900w'><figcaption>One {n}</figcaption></figure></div></article>"), [(f"{H}/b/fit-in/900x/{{n}}.jpg", "One {n}")]),
    "numerama": (
        page("<div class='article-content post-content'><figure><picture><source srcset='/a-{n}-s.jpg 300w, /a-{n}.jpg 900w'><source srcset='/a-{n}.webp 900w'><img src='/a-{n}-x.jpg'></picture><figcaption>One {n}</figcaption></figure><figure><blockquote><a href='https://twitter.com/u/status/99'>t</a></blockquote><figcaption>T</figcaption></figure></div>"),
        [(f"{H}/a-{{n}}.jpg", "One {n}"), ("tweet:99", "T")],
    ),
    "observalgerie": (
        page("<div class='entry-content'><figure><img src='/a-{n}'><figcaption>One {n}</figcaption></figure><img data-lazy-src='/b-{n}.jpg' alt='Two {n}'></div>"), [(f"{H}/a-{{n}}", "One {n}"), (f"{H}/b-{{n}}.jpg", "Two {n}")],
    ),
    "sciencefeedback": (
        page(f"<main>{fig('z', 'Before')}<h2 id='verification'>v</h2><figure><img src='/a-{{n}}.jpg'><figcaption>One {{n}}</figcaption></figure><h4 id='references'>r</h4>{fig('y', 'After')}</main>"), [(f"{H}/a-{{n}}.jpg", "One {n}")],
    ),
    "tf1info": (
        page("<article><figure><img src='/a-{n}.jpg'><figcaption>One {n}</figcaption></figure><div class='ReadMore'><img src='/z.jpg'></div><div class='Picture'><picture><source type='image/avif' srcset='/b-{n}-s.avif 300w'><source type='image/jpeg' srcset='/b-{n}.jpg 900w'><source srcset='/b-{n}-l.jpg 1800w'><img src='/b-{n}-x.jpg'></picture></div></article>"),
        [(f"{H}/a-{{n}}.jpg", "One {n}"), (f"{H}/b-{{n}}.jpg", "")],
    ),
}

_YT = "<iframe src='https://www.youtube-nocookie.com/embed/vid{n}xyz?rel=0&amp;x=1'></iframe>"
_FACADE = "<div data-facadesrc='https://www.youtube.com/embed/fac{n}xyz'></div>"
_SRCDOC = "<iframe srcdoc='&lt;a href=&quot;https://www.youtube.com/embed/doc{n}xyz?autoplay=1&quot;&gt;'></iframe>"
_WATCH = "<a href='https://www.youtube.com/watch?v=wat{n}xyz'>w</a>"
_DM = "<iframe src='https://geo.dailymotion.com/player/p1.html?mute=1&amp;video=dm{n}'></iframe>"
_FB = "<iframe data-src-cmplz='https://www.facebook.com/plugins/video.php?href=https%3A%2F%2Fwww.facebook.com%2Fp%2Fvideos%2F{n}%2F&amp;show=0'></iframe>"
_FB_PLUGIN = "https://www.facebook.com/plugins/video.php?href=https%3A%2F%2Fwww.facebook.com%2Fp%2Fvideos%2F{n}%2F&show=0"
_TW = "<iframe src='https://platform.twitter.com/embed/Tweet.html?dnt=true&amp;id=1{n}'></iframe>"
_STATUS = "<a href='https://twitter.com/u/status/2{n}'>s</a>"
_TT = "<iframe src='https://www.tiktok.com/embed/v2/3{n}'></iframe>"
_UM = "<iframe src='//www.ultimedia.com/deliver/generic/iframe/mdtk/{n}?a=1'></iframe>"
_MP4 = "<video><source src='//cdn.example/v{n}.mp4?sig=1'></video>"
_IG = "<a href='https://www.instagram.com/p/AB{n}/?utm=1'>i</a>"
_ALL = _YT + _FACADE + _SRCDOC + _WATCH + _DM + _FB + _TW + _STATUS + _TT + _UM + _MP4
_HEX = "0123456789abcdef0123"
_V = "https://vodvmsusoaws-cf.rtl.de"


def watch(name: str) -> str:
    return f"https://www.youtube.com/watch?v={name}{{n}}xyz"


def embed(name: str, tail: str = "?autoplay=1") -> str:
    return f"https://www.youtube.com/embed/{name}{{n}}xyz{tail}"


_RAW, _UM_URL, _DM_URL = "https://cdn.example/v{n}.mp4", "https://www.ultimedia.com/deliver/generic/iframe/mdtk/{n}", "https://www.dailymotion.com/embed/video/dm{n}"
_EMBEDS = [embed("doc"), embed("fac"), embed("vid")]
#: publisher: (page, videos in order).
VIDEOS: dict[str, tuple[str, list[str]]] = {
    "br": (
        page(
            f"{_ALL}<div class='ardplayer' data-mediajson='{{&quot;_mediaArray&quot;:[{{&quot;_mediaStreamArray&quot;:[{{&quot;_stream&quot;:[&quot;//ard.example/{{n}}-a.mp4&quot;,&quot;https:\\/\\/ard.example/{{n}}-b.m3u8&quot;]}},{{&quot;_stream&quot;:&quot;https://ard.example/{{n}}-c.mp4&quot;}}]}}]}}'></div>"
            "<section class='ArticleModuleMedia_wrapper_1'><video src='blob:x'><source src='https://ard.example/{n}-d.mp4'></video></section>",
            '<script type="application/ld+json">[{"@type": "VideoObject", "contentUrl": "https://ard.example/{n}-e.mp4"}, {"@type": "Thing", "contentUrl": "no"}]</script>',
        ),
        [watch("doc"), watch("fac"), watch("vid"), _FB_PLUGIN, "//ard.example/{n}-a.mp4", "https://ard.example/{n}-b.m3u8", "https://ard.example/{n}-c.mp4", "https://ard.example/{n}-d.mp4", "https://ard.example/{n}-e.mp4"],
    ),
    "rtl": (
        page(
            f"<main>{_YT}{_FB}<video src='{_V}/world-{_HEX}{{n}}-hls.m3u8'><source src='{_V}/world-{_HEX}{{n}}-progressive.mp4'><source src='{_V}/world-short-1.mp4'></video>"
            f"<div class='FoundationPlayer' data-src='https://adserver.rtl.de/ad.mp4'></div><script>var u = \"{_V}/world-{_HEX}{{n}}-a.m3u8\";</script></main>" + _FACADE
        ),
        [f"{_V}/world-{_HEX}{{n}}-progressive.mp4", f"{_V}/world-short-1.mp4", watch("vid"), _FB_PLUGIN],
    ),
    "stern": (page("<div data-renditions='{}'></div><div data-renditions=\"{&quot;progressive&quot;: {&quot;url&quot;: &quot;https://stern.example/{n}.mp4&quot;}}\"></div>" + _ALL), ["https://stern.example/{n}.mp4"]),
    "volksverpetzer": (page(_ALL), [watch("doc"), watch("fac"), watch("vid"), _FB_PLUGIN]),
    "factencheckafp": (page(_YT + _SRCDOC + _TW + _STATUS), [embed("vid"), embed("doc"), "https://twitter.com/i/web/status/1{n}"]),
    "defactobservatoire": (page(f"<div class='defacto-fact-check-body'>{_YT}{_SRCDOC}{_WATCH}{_UM}{_MP4}</div>{_FACADE}{_DM}"), sorted(["https://cdn.example/v{n}.mp4?sig=1", "https://www.ultimedia.com/deliver/generic/iframe/mdtk/{n}?a=1", embed("doc"), embed("vid"), embed("wat")])),
    "factuelafp": (page(f"<div id='block-factuel-content'><div class='g2item g2web'>{_YT}</div><div class='g2web'>{_MP4}</div><div>{_DM}</div></div>{_UM}"), sorted(["https://cdn.example/v{n}.mp4?sig=1", embed("vid")])),
    "fasocheck": (page(_YT + _WATCH + _FB + _UM + _MP4 + _TT), sorted([embed("vid"), embed("wat"), "https://www.facebook.com/p/videos/{n}", _UM_URL, _RAW])),
    "francetvinfo": (page(f"<div class='page-content-wrapper'>{_YT}{_SRCDOC}{_DM}{_TT}{_TW}{_STATUS}{_MP4}</div>{_FACADE}{_UM}"), sorted([embed("doc"), embed("vid"), _DM_URL, "https://www.tiktok.com/embed/v2/3{n}", "https://x.com/i/web/status/1{n}", _RAW])),
    "lemonde": (page(_YT + _SRCDOC + _DM + _TW + _MP4), sorted([embed("doc", ""), embed("vid", ""), _DM_URL])),
    "liberation": (page(_YT + _SRCDOC + _TW + _MP4 + _DM), [embed("doc"), embed("vid"), "https://x.com/i/web/status/1{n}"]),
    "numerama": (page(_YT + _SRCDOC + "<blockquote class='tiktok-embed' cite='https://www.tiktok.com/@u/video/4{n}'></blockquote>" + _MP4 + _TW), sorted([embed("doc"), embed("vid"), "https://www.tiktok.com/@u/video/4{n}"])),
    "20minutes": (
        page(f"{_YT}{_UM}<div class='EmbedInstagram__Wrapper-x'>{_IG}</div><a href='https://www.instagram.com/p/OUT{{n}}/'>o</a><blockquote class='tiktok-embed' cite='https://www.tiktok.com/@u/video/4{{n}}?x=1'></blockquote>{_MP4}"),
        sorted([embed("vid"), "https://www.ultimedia.com/deliver/generic/iframe/mdtk/{n}?a=1", "https://www.instagram.com/p/AB{n}/", "https://www.tiktok.com/@u/video/4{n}"]),
    ),
    "tf1info": (page(f"{_YT}<div class='EmbedInstagram__Wrapper-x'>{_IG}{_TW}</div>{_STATUS}{_MP4}"), sorted([embed("vid"), "https://www.instagram.com/p/AB{n}/", "https://x.com/i/web/status/1{n}"])),
    "any": (page(_ALL), sorted([*_EMBEDS, embed("wat"), _DM_URL, "https://www.facebook.com/p/videos/{n}", "https://x.com/i/web/status/1{n}", "https://x.com/i/web/status/2{n}", "https://www.tiktok.com/embed/v2/3{n}", _UM_URL, _RAW])),
}


def _features(keys: str) -> str:
    import base64

    return base64.urlsafe_b64encode(keys.encode()).decode().rstrip("=")


def _tweet(number: str, features: str = "", title: str = "") -> str:
    more = f"&amp;features={_features(features)}" if features else ""
    return f"<div class='twitter-tweet'><iframe title='{title}' src='https://platform.twitter.com/embed/Tweet.html?id={number}{more}'></iframe></div>"


#: Pages whose videos hang on V8 and V18: (publisher, page, videos).
VIDEO_ARMS: list[tuple[str, str, list[str]]] = [
    ("20minutes", page(_tweet("10001{n}", '{"a":{"tfw_hls_on":{"b":"x"}}}') + _tweet("10002{n}", '{"a":{"tfw_dark":1}}') + _tweet("10003{n}", title="X Post") + _tweet("10004{n}", title="A Video post")), ["https://x.com/i/web/status/10001{n}", "https://x.com/i/web/status/10004{n}"]),
    ("20minutes", page(_tweet("10005{n}", '{"mixed_media":["@owner{}"]}'.replace("{}", "")) + _tweet("7", title="video") + "<iframe title='video' src='https://platform.twitter.com/embed/Tweet.html?id=10006{n}'></iframe>"), ["https://x.com/owner/status/10005{n}"]),
    ("20minutes", page("<iframe src='https://www.youtube.com/embed/framed{n}'></iframe><a href='https://www.youtube.com/embed/linked{n}'>l</a>"), ["https://www.youtube.com/embed/framed{n}?autoplay=1"]),
    ("20minutes", page("<a href='https://www.youtube.com/embed/linked{n}'>l</a><script>var v = 'https://www.youtube.com/embed/script{n}';</script>"), ["https://www.youtube.com/embed/linked{n}?autoplay=1", "https://www.youtube.com/embed/script{n}?autoplay=1"]),
    ("lemonde", page("<iframe src='https://www.youtube.com/embed/framed{n}'></iframe><a href='https://www.youtube.com/embed/linked{n}'>l</a><script>play('//www.dailymotion.com/embed/video/dm{n}')</script>"), ["https://www.dailymotion.com/embed/video/dm{n}", "https://www.youtube.com/embed/framed{n}"]),
    ("lemonde", page("<p>https://www.youtube.com/embed/textual{n}</p>"), ["https://www.youtube.com/embed/textual{n}"]),
]
