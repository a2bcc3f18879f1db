"""Labelled pages to learn from, put together by rule from names that page authors use for parts of a page.

An element marked `data-main` is main text with all below it, one marked `data-other` is not.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

# Tags and class names of parts of pages.
AROUND = "div.page div.wrapper div.container div.site div.row div.layout section.layout div.column div.inner div.main main div.app div body"
MAIN = (
    "article main div.content div.article div.post div.entry-content section.story div.article-body div.main-text div.text "
    "div.post-body section.article-content div.story-body div.page-content div.body-copy div.single div.hentry div section article.post "
    "div.articleBody main.content div.prose div.rich-text"
)
OTHER = {
    "menu": "nav ul.menu div.navbar div.nav div.navigation div.breadcrumbs div.topnav nav.main-menu div.tabs div.toc ol.breadcrumb div.sub-menu menu",
    "header": "header div.header div.masthead div.top-bar div.logo div.branding header.site-header div.banner div.toolbar",
    "footer": "footer div.footer div.site-footer div.copyright div.bottom footer.page-footer div.colophon div.legal div.credits",
    "side": "aside div.sidebar div.widget div.related div.recommended aside.side div.trending div.popular div.most-read div.rail div.secondary div.see-also",
    "notice": "div.cookie-notice div.consent div.gdpr div.alert div.notice div.popup div.modal div.overlay div.paywall dialog div.message div.warning div.cookie-banner div.toast",
    "advert": "div.ad div.ads div.advert div.advertisement div.sponsored div.promo ins.adsbygoogle div.ad-slot aside.ad div.promotion div.sponsor div.banner-ad div.affiliate",
    "form": "form div.newsletter div.subscribe div.signup div.search form.search-form div.login fieldset div.contact-form div.poll div.survey",
    "comments": "div.comments section.comments div.comment ol.comment-list div.disqus div.replies div.discussion article.comment div.reader-comments div.responses div.feedback",
    "share": "div.share div.social ul.social-links div.tags div.share-buttons div.pagination div.pager div.tag-list",
}
INSIDE = ("advert", "share", "side", "form", "notice", "menu", "comments", "form", "advert")
PAGES = 400


def _words(rnd: random.Random, n: int) -> str:
    said = ["".join(rnd.choices("aeioulnrst", k=rnd.randint(1, 9))) for _ in range(n)]
    return " ".join(said).capitalize()


def _open(rnd: random.Random, names: str, mark: str = "") -> tuple[str, str]:
    tag, _, name = rnd.choice(names.split()).partition(".")
    given = rnd.choice(["class", "class", "id"])
    return f"<{tag}{f' {given}={chr(34)}{name}{chr(34)}' if name else ''}{mark}>", f"</{tag}>"


def _sentences(rnd: random.Random) -> str:
    return " ".join(_words(rnd, rnd.choice([1, 3, 8, 20])) + rnd.choice([".", ".", ".", "!", "?", ",", ""]) for _ in range(rnd.choice([1, 1, 2, 4, 9])))


def _main_block(rnd: random.Random) -> str:
    kind = rnd.random()
    if kind < 0.08:
        return "<ul>" + "".join(f"<li>{_sentences(rnd)}</li>" for _ in range(rnd.randint(1, 5))) + "</ul>"
    if kind < 0.13:
        return f"<blockquote><p>{_sentences(rnd)}</p></blockquote>"
    if kind < 0.18:
        return f"<h{(n := rnd.randint(2, 4))}>{_words(rnd, rnd.randint(1, 7))}</h{n}>"
    if kind < 0.22:
        return f"<figure><figcaption>{_sentences(rnd)}</figcaption></figure>"
    if kind < 0.26:
        return "<table>" + "".join(f"<tr><td>{_words(rnd, 2)}</td><td>{_words(rnd, 1)}</td></tr>" for _ in range(3)) + "</table>"
    if kind < 0.30:
        return f"<div>{_sentences(rnd)}</div>"
    if kind < 0.33:
        return f"<section><h2>{_words(rnd, 3)}</h2><p>{_sentences(rnd)}</p><p>{_sentences(rnd)}</p></section>"
    if kind < 0.36:
        return f"<p>{_words(rnd, 3)} <a href=x>{_words(rnd, 2)}</a> {_sentences(rnd)}</p>"
    if kind < 0.39:
        return f"<pre>{_sentences(rnd)}</pre>"
    return f"<p>{_sentences(rnd)}</p>"


def _other(rnd: random.Random, kind: str) -> str:
    start, end = _open(rnd, OTHER[kind], " data-other")
    if kind in ("menu", "share"):
        links = [f'<a href="x">{_words(rnd, rnd.randint(1, 3))}</a>' for _ in range(rnd.randint(1, 8))]
        inner = "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>" if rnd.random() < 0.7 else " ".join(links)
    elif kind == "footer":
        inner = f"&copy; {_words(rnd, 2)} &middot; {_words(rnd, rnd.randint(1, 9))}." + rnd.choice(["", f"<p>{_words(rnd, 3)}</p>"])
    elif kind == "header":
        inner = rnd.choice(["<h1>{}</h1>", "<p>{}</p>", "<div>{}</div>", "{}"]).format(_words(rnd, rnd.randint(1, 4)))
    elif kind == "form":
        inner = f"<label>{_words(rnd, 2)}</label><input><button>{_words(rnd, 1)}</button>" + rnd.choice(["", f"<p>{_sentences(rnd)}</p>"])
    elif kind == "comments":
        inner = rnd.choice(["", f"<h3>{_words(rnd, 2)}</h3>"]) + "".join(
            rnd.choice(["<p>{}</p>", "<div><p>{}</p></div>", "<div class='comment-body'><p>{}</p></div>", "<li>{}</li>"]).format(_sentences(rnd))
            for _ in range(rnd.randint(1, 5))
        )
    elif kind == "side":
        inner = rnd.choice([f"<h3>{_words(rnd, 2)}</h3>", ""]) + rnd.choice(
            ["".join(f"<li><a href=x>{_words(rnd, 6)}</a></li>" for _ in range(4)), f"<p>{_sentences(rnd)}</p>", f"<div>{_sentences(rnd)}</div>"]
        )
    else:
        inner = rnd.choice(["<p>{}</p>", "{}", "<div>{}</div>", "<a href=x>{}</a>"]).format(_sentences(rnd))
    return start + inner + end


def _main(rnd: random.Random) -> str:
    blocks = [_main_block(rnd) for _ in range(rnd.randint(1, 12))]
    for _ in range(rnd.choice([0, 0, 1, 2])):
        blocks.insert(rnd.randint(0, len(blocks)), _other(rnd, rnd.choice(INSIDE)))
    if rnd.random() < 0.7:
        heading = f"<h1>{_words(rnd, rnd.randint(1, 9))}</h1>"
        blocks.insert(0, rnd.choice([heading, heading, f"<header>{heading}</header>", f"<div class=title>{heading}</div>"]))
    if rnd.random() < 0.08:
        # No element around the text.
        return "".join(b if " data-other" in b else b.replace(">", " data-main>", 1) for b in blocks)
    start, end = _open(rnd, MAIN, " data-main")
    text = start + "".join(blocks) + end
    if rnd.random() < 0.3:
        start, end = _open(rnd, MAIN, " data-main")
        text = start + text + end
    return text


def labelled_pages(n: int = PAGES, seed: int = 1) -> Iterator[str]:
    """Pages with marked parts; the same for the same seed."""
    rnd = random.Random(seed)
    for _ in range(n):
        before = [_other(rnd, k) for k in ("notice", "header", "menu", "advert", "form", "side", "share") if rnd.random() < 0.4]
        after = [_other(rnd, k) for k in ("side", "comments", "share", "advert", "form", "footer", "notice", "menu") if rnd.random() < 0.45]
        middle = _main(rnd)
        for _ in range(rnd.choice([0, 1, 1, 2])):
            start, end = _open(rnd, AROUND)
            if rnd.random() < 0.5 and after:
                middle += after.pop(0)
            if rnd.random() < 0.4 and before:
                middle = before.pop() + middle
            middle = start + middle + end
        yield "<body>" + "".join(before) + middle + "".join(after) + "</body>"
