"""Labelled pages that the text extraction is trained on.

Written for this purpose; ``*`` before a tag name marks an element whose own text is content.
They show the ways pages are built: with and without semantic tags, with class names only, with
unclosed tags, with the article in a table or in plain blocks, with lists and quotes as content.
"""

from __future__ import annotations

_LONG = (
    "The river rose for three days before the town council met, and by then the lower streets were "
    "already closed to carts. Nobody had expected the spring to come so early this year."
)
_MORE = "Farmers moved their stock to the hill pastures, where the grass had only begun to show, and waited."
_QUOTE = "We have seen worse, said the miller, but not in April and never twice in a week."
_NAV = "<ul><li><a href=/>Home</a></li><li><a href=/news>News</a></li><li><a href=/about>About us</a></li></ul>"
_COMMENT = "<div class=comment><b>anna</b><p>I remember the flood of my youth, it was much worse than this one.</p></div>"

PAGES = (
    f"""<html><head><title>Flood</title><style>p{{}}</style><script>var a="<p>x</p>";</script></head><body>
    <nav>{_NAV}</nav><div class="ad">Buy boots at half price today.</div>
    <*article><*h1>The flood</*h1><*p>{_LONG}</*p><*p>{_MORE}</*p><*blockquote>{_QUOTE}</*blockquote></*article>
    <footer>&copy; 2020 The Courier &middot; All rights reserved.</footer></body></html>""",
    f"""<body><header><h1>The Courier</h1><p>News from the valley since 1890</p></header>
    <*main><*h2>A wet spring</*h2><*p>{_LONG}</*p><*ul><*li>Bring a lamp and dry clothes for two days.</*li>
    <*li>Keep away from the lower bridge.</*li></*ul><*p>{_MORE}</*p></*main>
    <aside><h3>Most read</h3><ul><li><a href=/1>Fair opens</a></li><li><a href=/2>Prices fall</a></li></ul></aside>
    <section id="comments"><h3>Comments</h3>{_COMMENT}{_COMMENT}</section>
    <form action=/search><label>Search</label><input name=q><button>Go</button></form>
    <footer><p>Contact the editors by letter.</p></footer></body>""",
    f"""<div id="wrapper"><div id="header"><a href=/>Logo</a><div class="menu">{_NAV}</div></div>
    <div class="breadcrumb"><a href=/>Home</a> &gt; <a href=/news>News</a></div>
    <*div id="content" class="post-body"><*h1>Market day</*h1><*p>{_LONG}</*p><*p>{_MORE}</*p>
    <div class="share-buttons"><a href=#>Share</a> <a href=#>Tweet</a></div></*div>
    <div class="sidebar widget"><h4>Archive</h4><p>Read older issues of the paper here.</p></div>
    <div class="cookie-notice">This site uses cookies. <button>Accept</button></div>
    <div id="footer">Imprint | Privacy | Terms</div></div>""",
    f"""<table><tr><td class="navbar"><a href=a>One</a><br><a href=b>Two</a></td>
    <*td class="article-text"><*h3>Old mill sold</*h3><*p>{_MORE}</*p><*p>{_QUOTE}</*p></*td>
    <td class="adverts">Sponsored: the best flour in town, order now.</td></tr></table>""",
    f"""<body><nav>{_NAV}</nav><*article><*h1>Short</*h1><*p>{_QUOTE}</*p></*article>
    <div class="newsletter-signup"><form><p>Subscribe to our letter and never miss a story.</p><input></form></div>
    <div class="related-posts"><h3>You may also like</h3><ul><li><a href=1>{_QUOTE}</a></li></ul></div>
    <div class="comments-area">{_COMMENT}<div class="reply"><p>{_LONG}</p></div></div><footer>Bye</footer></body>""",
    f"""<body><div class="banner alert">The office is closed on Monday.</div><div class="main-nav">{_NAV}</div>
    <*div class="entry-content"><*p>{_LONG}</*p><*pre>x = 1</*pre><*p>{_MORE}</*p><*div>{_QUOTE}</*div></*div>
    <div class="promo">Win a journey to the coast. Enter your name below.</div>
    <div class="copyright">Copyright 1999 by the authors</div></body>""",
    f"""<body><*section class="story"><*h2>Harvest</*h2><*p>{_MORE}</*p><*p>{_LONG}</*p><*figure><*figcaption>The mill
    in March</*figcaption></*figure></*section><div role="navigation">{_NAV}</div>
    <div role="complementary"><p>Weather: rain and wind from the west for the rest of the week.</p></div>
    <div role="contentinfo">Printed in the valley</div></body>""",
    f"""<body><*p>{_LONG}</*p><*p>{_MORE}</*p><*p>{_QUOTE}</*p><div class=menu><a href=x>Next</a></div></body>""",
    f"""<body><div class="popup modal"><p>Sign in to read more of this and other stories.</p></div>
    <*article><header><p>By the editor, 3 May</p></header><*p>{_LONG}</*p><*p>{_MORE}</*p>
    <aside class="pullquote ad"><p>Advertisement</p></aside><*p>{_QUOTE}</*p>
    <footer><a href=t>Tags</a></footer></*article><noscript>Turn on scripts.</noscript></body>""",
)

# Words of class, id and role that name what is apart from the content, and elements
# that hold it.
APART_NAMES = (
    "nav navigation navbar menu submenu sidebar widget footer header masthead banner ad ads advert adverts "
    "advertisement sponsor sponsored promo promotion cookie cookies consent notice notices alert warning popup modal "
    "overlay comment comments commentlist reply replies respond disqus discussion thread feedback share sharing social "
    "related recommended recommendations newsletter subscribe signup login register breadcrumb breadcrumbs pagination "
    "pager toolbar topbar bottom search tags meta copyright legal imprint disclaimer links archive archives complementary "
    "contentinfo form survey poll rating credits outbrain taboola teaser trending popular"
).split()
CONTENT_BOXES = (
    "article", "main", 'div class="content"', 'div id="main-content"', 'div class="post"', 'section class="story"',
    'div class="article-body"', 'div class="entry text"', 'article class="post single"', "div",
)
APART_BOXES = ("div", "section", "aside", "div", "ul", "footer", "header", "nav", "form", "div")


def _apart(name: str, number: int) -> str:
    """Something apart: short or long, with or without headings and links, flat or nested."""
    tag = APART_BOXES[number % len(APART_BOXES)]
    inside = (
        f"<p>{_LONG}</p>",
        f"<h3>{name.title()}</h3><p>{_QUOTE}</p><p>{_MORE}</p>",
        _NAV,
        f"<div><p>{_MORE}</p><div><b>joe</b> <span>{_QUOTE}</span></div></div>",
        f"{_QUOTE} <a href=/more>More</a>",
    )[number % 5]
    named = "" if tag in ("footer", "header", "nav", "aside") and number % 2 else f' class="{name}"'
    if tag == "ul":
        inside = f"<li>{_QUOTE}</li><li><a href=/x>{name}</a></li>"
    return f"<{tag}{named}>{inside}</{tag}>"


def labelled_pages() -> list[str]:
    """The pages above, and pages by rule: every name apart, beside or inside every kind of content."""
    pages = list(PAGES)
    for number, name in enumerate(APART_NAMES):
        for turn in range(3):
            k = number + turn * 7
            box = CONTENT_BOXES[(number + turn) % len(CONTENT_BOXES)]
            apart = _apart(name, k)
            title = ("<*h1>Spring</*h1>", "<*h2>Spring</*h2>", "")[k % 3]
            body = (
                f"{title}<*p>{_LONG}</*p><*p>{_MORE}</*p><*p>Yes.</*p>",
                f"{title}<*p>{_QUOTE}</*p><*ul><*li>{_MORE}</*li><*li>Lamps</*li></*ul><*p>See <a href=/m>the map</a>.</*p>",
                f"<*div>{title}<*p>{_LONG}</*p><*blockquote><*p>{_QUOTE}</*p></*blockquote></*div>",
            )[turn]
            inside = apart if turn == 2 and "<form" not in apart else ""
            close = box.split()[0]
            content = f"<*{box}>{body}{inside}</*{close}>"
            parts = [_apart(APART_NAMES[(k * 5) % len(APART_NAMES)], k + 3), content, "" if inside else apart]
            wrapper = "<div id=page>" if k % 2 else ""
            pages.append(f"<html><body>{wrapper}{''.join(parts)}{'</div>' if wrapper else ''}</body></html>")
    return pages
