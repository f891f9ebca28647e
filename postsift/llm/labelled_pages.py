"""The small labelled table of the main-text tree: invented pages with the article's blocks marked."""

from __future__ import annotations

import random
import re


def keep(text: str) -> tuple[str]:
    """A block that belongs to the article."""
    return (text,)


def page(*parts: str | tuple[str]) -> tuple[str, frozenset[str]]:
    """(html, texts of the article's blocks); parts are markup, or marked texts."""
    return "".join(p if isinstance(p, str) else p[0] for p in parts), frozenset(p[0] for p in parts if not isinstance(p, str))


LONG = "The river rose for three days before the old bridge gave way, and the people of the valley moved their cattle to the upper meadows."
LONGER = "Nobody had measured the water since the mill closed, so the council asked the school to keep a diary of its level through the winter months."
THIRD = "In spring the pupils drew a map of every field that had been flooded and hung it in the town hall, where it can still be seen."
MIDDLE = "The diary was read aloud at the autumn fair."
NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/news'>News</a></li><li><a href='/shop'>Shop</a></li><li><a href='/about'>About us</a></li></ul></nav>"
DIV_NAV = "<div class='menu'><a href='/'>Home</a> <a href='/a'>Archive</a> <a href='/b'>Contact</a></div>"
BARE_NAV = "<div><a href='/'>Home</a> | <a href='/a'>Archive</a> | <a href='/b'>Write to us</a></div>"
AD = "<div class='ad'>Buy two lamps today and get the third one free at the market.</div>"
COOKIES = "<div id='cookie-notice'>We use cookies to make this site work better for you. By reading on you agree to our use of them.</div>"
SIDEBAR = "<aside><h3>More stories</h3><p>A farmer finds a bell in the mud of the old fish pond and brings it home.</p><a href='/x'>Read on</a></aside>"
SIDE_DIV = "<div class='sidebar'><h4>Weather</h4><p>Cloudy with showers over the hills, dry and mild along the coast until the evening.</p></div>"
COMMENTS = "<section class='comments'><h2>Comments</h2><div><p>I remember that winter very well, we had to use the boat to reach the barn.</p></div><p>Great story, thank you for writing it down!</p></section>"
COMMENT_LIST = "<ol id='comments'><li><p>My uncle worked at this mill and told us about the flood every Christmas.</p></li><li>Me too</li></ol>"
FORM = "<form action='/s'><label>Search</label><input name='q'><p>Type a word and press the button to search all stories of this site.</p></form>"
HEADER = "<header><h1>The Valley Paper</h1><p>News from the hills since the year the railway came</p></header>"
FOOTER = "<footer><p>All rights reserved by the publishers of the valley paper and their heirs.</p><a href='/i'>Imprint</a></footer>"
FOOT_DIV = "<div class='footer'>Printed with care by the valley press company in the old station building.</div>"
SHARE = "<div class='share'><a href='#'>Share</a> <a href='#'>Send to a friend</a></div>"
RELATED = "<div class='related'><h3>Related</h3><ul><li><a href='/1'>The bell in the pond</a></li><li><a href='/2'>Ten years of snow</a></li></ul></div>"
BARE_FOOT = "<div>&copy; The paper</div>"

PAGES = (
    page(NAV, AD, "<article><h1>", keep("The flood"), "</h1><p>", keep(LONG), "</p><p>", keep(LONGER), "</p><p>", keep("So be it."), "</p></article>", FOOTER),
    page(HEADER, NAV, "<main><h2>", keep("A short report"), "</h2><p>", keep("Rain."), "</p><p>", keep("More rain."), "</p><p>", keep(LONG), "</p>", AD, "<p>", keep(MIDDLE), "</p></main>", SIDEBAR, FOOTER),
    page(COOKIES, NAV, "<article><header><h1>", keep("The diary"), "</h1><p>By our reporter in the hills</p></header><p>", keep(LONGER), "</p>", SHARE, "<blockquote>", keep("It never stops."), "</blockquote><p>", keep(THIRD), "</p>", COMMENTS, "</article>", FOOT_DIV),
    page(DIV_NAV, "<div class='content'><h1>", keep("Mill closed"), "</h1><p>", keep(LONG), "</p><ul><li>", keep("one wheel"), "</li><li>", keep("two stones"), "</li></ul><p>", keep(MIDDLE), "</p></div>", SIDE_DIV, FOOT_DIV),
    page("<div class='header'><h1>Hill News</h1></div>", DIV_NAV, "<div id='main'><p>", keep(THIRD), "</p>", AD, "<p>", keep("The end."), "</p>", FORM, "</div>", COMMENT_LIST, FOOT_DIV),
    page(BARE_NAV, "<div>", keep(LONG), "</div><div>", keep(LONGER), "</div><div>", keep(THIRD), "</div>", BARE_FOOT),
    page(BARE_NAV, "<p>", keep(LONGER), "</p><p>", keep(LONG), "</p>", COOKIES, "<p>", keep(THIRD), "</p>", BARE_FOOT, FORM),
    page("<table><tr><td><a href='/'>Start</a></td><td><a href='/k'>Maps of the valley</a></td></tr></table><p>", keep(LONG), "</p><p>", keep(THIRD), "</p>", SIDEBAR, "<div><a href='/n'>next page of this story</a></div>"),
    page(NAV, "<article><h1>", keep("Links"), "</h1><p>", keep(MIDDLE), "</p><ul><li><a href='/m'>", keep("A map of the flooded fields"), "</a></li><li><a href='/d'>", keep("Diary"), "</a></li></ul><p>", keep("See above."), "</p></article>", RELATED, COMMENTS, FOOTER),
    page(NAV, "<main><article><p>", keep("Short."), "</p>", "<aside>Did you know that the bridge was painted blue for the visit of the king?</aside><p>", keep(LONG), "</p><div class='notice'>This story was updated on Monday with the new level of the water.</div></article>", SIDE_DIV, "</main>", FOOTER),
    page(NAV, AD, "<article><h1>", keep("Bell"), "</h1><p>", keep("In the pond."), "</p><p>", keep("At home."), "</p><h2>", keep("Later"), "</h2><p>", keep(THIRD), "</p><table><tr><td>", keep("year"), "</td><td>", keep("1901"), "</td></tr></table></article>", FORM, COMMENT_LIST, FOOTER),
    page(HEADER, DIV_NAV, COOKIES, "<div class='post'><h2>", keep("Snow"), "</h2><p>", keep("Ten years."), "</p><p>", keep(LONGER), "</p>", RELATED, SHARE, "</div>", COMMENTS, FOOT_DIV),
    page(BARE_NAV, "<div>Menu</div><div>", keep(LONGER), "</div><div>Top</div><div>", keep(THIRD), "</div><div><a href='/p'>Earlier stories</a> and <a href='/q'>later stories</a></div>", BARE_FOOT),
    page(NAV, "<h1>", keep("The old well"), "</h1><p>", keep("It was dry."), "</p><p>", keep(LONG), "</p><p>", keep("We dug again."), "</p><h2>", keep("Deeper"), "</h2><p>", keep(MIDDLE), "</p>", FOOTER),
    page(DIV_NAV, AD, "<h1>", keep("Two sheep"), "</h1><p>", keep("One was black."), "</p><p>", keep(THIRD), "</p><p><a href='/v'>All stories about animals</a></p><p><a href='/w'>Print</a></p><p><a href='/y'>Subscribe here</a></p>", FOOT_DIV),
    page(NAV, "<article><header><h1>", keep("Harvest"), "</h1><p>By a friend of the paper</p><span>12 May</span></header><p>", keep("Late."), "</p><p>", keep(LONGER), "</p></article>", FOOTER),
    page("<header><p>News from all over the valley for everyone who lives here or has left it</p></header>", NAV, "<main><header><h2>", keep("Frost"), "</h2><div>Reading time 3 minutes</div><p>Posted by the desk</p></header><p>", keep(MIDDLE), "</p></main>", FOOTER),
    page(BARE_NAV, "<div>Today</div><h2>", keep("Market day"), "</h2><p>", keep("Eggs were dear."), "</p><p>", keep(LONG), "</p><div>Advertise here</div><p>", keep("Butter was not."), "</p><div>Follow the paper</div>", BARE_FOOT),
    page(NAV, "<article><h1>", keep("Rope"), "</h1><pre>", keep("over under through"), "</pre><div>", keep("Pull."), "</div><ul><li>", keep("hemp"), "</li><li>", keep("flax"), "</li></ul><dl><dt>", keep("knot"), "</dt><dd>", keep("a loop"), "</dd></dl></article>"),
    page("<article><p>", keep("First."), "</p><p>", keep("Last."), "</p></article>"),
    page(NAV, "<main><p><a href='/s'>", keep("The source of this story"), "</a></p><p><a href='/t'>", keep("A second source"), "</a></p><blockquote>", keep("Water finds its way."), "</blockquote><div>", keep("Signed by all."), "</div></main>"),
    page("<h1>", keep("Salt"), "</h1><p>", keep("It came by cart."), "</p><p>", keep("It left by boat."), "</p>"),
    page("<p>", keep("One line."), "</p><p>", keep("Another line."), "</p>"),
    page(keep(LONG)),
    page(NAV, "<article><div><a href='/r'>", keep("Read the first part"), "</a></div><div>", keep("Here is the second."), "</div><table><tr><td>", keep("May"), "</td><td>", keep("June"), "</td></tr></table><figure><figcaption>", keep("The well in June"), "</figcaption></figure></article>", FOOTER),
    page(HEADER, "<main><section><h3>", keep("Bees"), "</h3><div>", keep("They slept."), "</div></section><section><h3>", keep("Wasps"), "</h3><div>", keep("They did not."), "</div></section></main>", SIDEBAR),
)

#: Elements whose names tell what they hold, as plain ones.
TELLING = re.compile(r"<(/?)(?:nav|menu|aside|footer|header|form|dialog|article|main|section)\b")
ATTRIBUTES = re.compile(r"\s(?:class|id|role)='[^']*'")


def unnamed(html: str) -> str:
    """The page without any name that tells what a part of it is."""
    return TELLING.sub(r"<\1div", ATTRIBUTES.sub("", html))


#: The same pages without telling names: here words, links and neighbours must decide.
UNNAMED_PAGES = tuple((unnamed(html), wanted) for html, wanted in PAGES)

# --- pages made by rule --------------------------------------------------------------------

WORDS = f"{LONG} {LONGER} {THIRD} {MIDDLE}".replace(",", "").replace(".", "").lower().split()

#: What is not the article: (element with a telling name, classes that tell, content by `says` and `links`).
BOILER = {
    "header": ("header", ("header", "masthead"), "<h1>{t3}</h1><p>{t9}</p>"),
    "nav": ("nav", ("menu", "navbar"), "<ul>{links}</ul>"),
    "inline nav": ("nav", ("menu", "breadcrumb"), "{inline}"),
    "ad": ("div", ("ad", "promo"), "{t9}"),
    "long ad": ("div", ("advert", "sponsored"), "<p>{t25}</p>"),
    "notice": ("div", ("cookie-banner", "notice"), "{t25}"),
    "sidebar": ("aside", ("sidebar", "widget"), "<h3>{t3}</h3><p>{t25}</p>{inline}"),
    "share": ("div", ("share", "social"), "{inline}"),
    "related": ("aside", ("related", "recommended"), "<h3>{t3}</h3><ul>{links}</ul>"),
    "form": ("form", ("search", "newsletter"), "<label>{t3}</label><input name='q'><p>{t9}</p>"),
    "comments": ("section", ("comments", "replies"), "<h3>{t3}</h3><div><p>{t25}</p></div><div><p>{t9}</p></div>"),
    "footer": ("footer", ("footer", "legal"), "&copy; {t9}"),
    "long footer": ("footer", ("footer", "copyright"), "<p>{t25}</p>{inline}"),
}
BEFORE, BETWEEN, AFTER = ("header", "nav", "inline nav", "ad", "notice"), ("ad", "long ad", "share", "notice"), ("sidebar", "related", "form", "comments", "share")
#: What an article is made of, the longest of its texts in words; a part that stands twice is met twice as often.
ARTICLE = (
    ("<p>", "</p>", 60), ("<p>", "</p>", 60), ("<p>", "</p>", 30), ("<p>", "</p>", 5), ("<p><b>", "</b></p>", 12), ("<h2>", "</h2>", 6),
    ("<ul><li>", "</li></ul>", 8), ("<div>", "</div>", 40), ("<blockquote>", "</blockquote>", 25), ("<table><tr><td>", "</td></tr></table>", 3), ("<p><a href='/s'>", "</a></p>", 6),
    ("<pre>", "</pre>", 10), ("<figure><figcaption>", "</figcaption></figure>", 8),
)


def made_page(seed: int) -> tuple[str, frozenset[str]]:
    """An invented page: names tell by element, by class, or not at all (every third page each)."""
    rng, style = random.Random(seed), seed % 3

    def says(n: int) -> str:
        return " ".join(rng.choice(WORDS) for _ in range(rng.randint(max(1, n // 2), n))).capitalize() + rng.choice(("", "."))

    def boiler(kind: str) -> str:
        element, classes, content = BOILER[kind]
        links = [f"<a href='/{k}'>{says(2)}</a>" for k in range(rng.randint(2, 7))]
        inside = content.format(t3=says(3), t9=says(9), t25=says(25), links="".join(f"<li>{x}</li>" for x in links), inline=rng.choice((" ", " | ")).join(links))
        if style == 2:
            return f"<div>{inside}</div>"
        return f"<{element}>{inside}</{element}>" if style == 0 and element != "div" else f"<div class='{rng.choice(classes)}'>{inside}</div>"

    parts: list[str | tuple[str]] = [boiler(k) for k in BEFORE if rng.random() < 0.6]
    parts.append(("<article>", "<div class='content'>", "<div>")[style])
    if rng.random() < 0.8:
        parts += ["<h1>", keep(says(8)), "</h1>"]
    for _ in range(rng.randint(1, 9)):
        begin, end, longest = rng.choice(ARTICLE)
        parts += [begin, keep(says(longest)), end]
        if rng.random() < 0.15:
            parts.append(boiler(rng.choice(BETWEEN)))
    parts.append("</article>" if style == 0 else "</div>")
    parts += [boiler(k) for k in AFTER if rng.random() < 0.4]
    parts.append(boiler(rng.choice(("footer", "long footer"))))
    return page(*parts)


#: The labelled table: pages by hand, the same without names, and pages made by rule.
LABELLED = (*PAGES, *UNNAMED_PAGES, *(made_page(seed) for seed in range(180)))
