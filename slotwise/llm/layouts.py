"""Labelled pages: usual layouts with their content marked. ``data-main`` opens content, ``data-out``
takes a part out again."""

from __future__ import annotations

LONG = (
    "The harbour was rebuilt after the storm, and the first ships came back in spring. Engineers raised the outer wall "
    "by two metres, and the town paid for it over a decade; few people remember the debate, but the plans survive."
)
MIDDLE = "Visitors reach the old quay on foot. A small museum shows tools, charts and letters of the crews."
SHORT = "Prices rose again."
TITLE = "A harbour and its town"
ITEMS = "<li>Take the coast road, then turn left at the mill.</li><li>Bring water and a map, as there is no shop.</li>"
MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li><li><a href="/c">Contact</a></li></ul>'
LINKS = '<h3>Related stories</h3><ul><li><a href="/1">Ten walks by the sea</a></li><li><a href="/2">How walls are built, and why they last.</a></li></ul>'
COMMENT = "<p>Great article, thank you! I was there last summer, and the museum was closed all week.</p>"
BODY = f"<h1>{TITLE}</h1><p>{LONG}</p><h2>On foot</h2><p>{MIDDLE}</p><ul>{ITEMS}</ul><blockquote><p>{MIDDLE}</p></blockquote><p>{SHORT}</p>"
PLAIN = f"<h1>{TITLE}</h1><p>{LONG}</p><p>{MIDDLE}</p><p>{SHORT}</p><p><a href='/x'>{SHORT}</a> {LONG}</p><table><tr><th>Year</th><th>Ships</th></tr><tr><td>1901</td><td>12</td></tr></table>"
FOOT = "<p>&copy; 2024 The Coast Post. All rights reserved.</p><a href='/privacy'>Privacy</a> <a href='/terms'>Terms</a>"
COOKIES = "<p>We use cookies to improve this site. By going on you accept our policy.</p><a href='#'>Accept</a>"
ADVERT = "<p>Buy two pairs of shoes and get the third free, only this week.</p>"
FORM = "<label>Your e-mail</label><input name='m'><p>Sign up for our weekly letter and never miss a story.</p>"


def labelled_layouts() -> list[str]:
    body, plain = BODY, PLAIN
    pages = [
        f"<nav>{MENU}</nav><div class='ad'>{ADVERT}</div><article data-main>{body}</article><footer>{FOOT}</footer>",
        f"<header><a href='/'>The Coast Post</a><p>{SHORT}</p><nav>{MENU}</nav></header><main><article data-main>{plain}"
        f"</article><aside>{LINKS}<p>{MIDDLE}</p></aside></main><footer><p>{MIDDLE}</p>{FOOT}</footer>",
        f"<div id='header'><div class='logo'>The Coast Post</div><div class='menu'>{MENU}</div></div><div id='content'><div class='post' data-main>{body}"
        f"</div><div class='sidebar'>{LINKS}<div class='widget'><p>{LONG}</p></div></div></div><div id='footer'>{FOOT}</div>",
        f"<div class='cookie-notice'>{COOKIES}</div><div class='wrapper'><div class='entry-content' data-main>{plain}</div>"
        f"<div id='comments'><h3>Comments</h3><div class='comment'>{COMMENT}</div><div class='comment'><p>{LONG}</p></div></div></div>",
        f"<nav>{MENU}</nav><main data-main>{body}<section class='comments' data-out><h2>Comments</h2><article class='comment'>{COMMENT}<p>{LONG}</p></article></section></main>"
        f"<aside class='sidebar'><p>{LONG}</p>{LINKS}</aside><footer>{FOOT}</footer>",
        f"<article data-main>{plain}<aside data-out><p>{LONG}</p></aside><form data-out>{FORM}</form><footer data-out><p>{MIDDLE}</p></footer></article><footer>{FOOT}</footer>",
        f"<article data-main><header data-out><p>By Ann Lee</p></header>{body}<div class='ad' data-out><p>{LONG}</p></div><p>{LONG}</p>"
        f"<div class='share' data-out><a href='#'>Share</a> <a href='#'>Tweet</a></div></article><div class='related'>{LINKS}</div>",
        f"<div class='notice'><p>{MIDDLE}</p></div><div class='banner'>{ADVERT}</div><div class='article-body' data-main>{body}<div class='newsletter' data-out>{FORM}<p>{LONG}</p></div></div>"
        f"<form action='/s'>{FORM}<p>{MIDDLE}</p></form>",
        f"<table><tr><td><div class='nav'>{MENU}</div></td><td><div class='main' data-main>{plain}</div></td></tr></table><div class='copyright'>{FOOT}</div>",
        f"<div>{MENU}</div><div data-main><h1>{TITLE}</h1><p>{LONG}</p><p>{LONG}</p><p>{MIDDLE}</p></div><div><a href='/a'>More</a> | <a href='/b'>Next</a></div>",
        f"<nav>{MENU}</nav><article data-main><h1>{TITLE}</h1><p>{SHORT}</p></article><footer>{FOOT}</footer>",
        f"<nav>{MENU}</nav><div role='alert'><p>{LONG}</p></div><article data-main><h1>{SHORT}</h1><p><b>{SHORT}<br><p>{LONG}</p></article><div class='promo'><p>{LONG}</p></div><footer>{FOOT}</footer>",
        f"<header><h1>The Coast Post</h1><p>{LONG}</p></header><article data-main>{plain}</article><section id='disqus_thread'><div><p>{LONG}</p>{COMMENT}</div></section>",
        f"<aside><p>{LONG}</p></aside><section data-main>{body}</section><section class='reader-comments'><ul><li><p>{LONG}</p></li><li>{COMMENT}</li></ul></section><dialog open><p>{MIDDLE}</p></dialog>",
    ]
    # Each kind of part that is not content, within content.
    parts = [
        f"<aside data-out><p>{LONG}</p></aside>", f"<aside data-out><h3>{SHORT}</h3><p>{MIDDLE}</p></aside>",
        f"<form data-out><p>{LONG}</p>{FORM}</form>", f"<form data-out>{FORM}</form>",
        f"<div class='comments' data-out><p>{LONG}</p></div>", f"<ol class='comment-list' data-out><li><p>{LONG}</p></li></ol>",
        f"<div class='ad' data-out>{ADVERT}</div>", f"<div class='sponsored' data-out><p>{LONG}</p></div>",
        f"<div class='cookie-banner' data-out>{COOKIES}</div>", f"<div class='notice' data-out><p>{LONG}</p></div>",
        f"<nav data-out>{MENU}</nav>", f"<footer data-out><p>{LONG}</p></footer>", f"<header data-out><p>{LONG}</p></header>",
        f"<div class='sidebar' data-out><p>{LONG}</p></div>", f"<div class='related' data-out>{LINKS}</div>",
        f"<dialog data-out><p>{LONG}</p></dialog>", f"<div style='display:none' data-out><p>{LONG}</p></div>",
    ]
    hosts = [("<article data-main>", "</article>"), ("<main data-main>", "</main>"), ("<div class='content' data-main>", "</div>")]
    for k, part in enumerate(parts):
        start, end = hosts[k % len(hosts)]
        pages.append(f"<nav>{MENU}</nav>{start}<h1>{TITLE}</h1><p>{LONG}</p>{part}<p>{MIDDLE}</p>{end}<footer>{FOOT}</footer>")
        start, end = hosts[(k + 1) % len(hosts)]
        pages.append(f"<header>{MENU}</header>{start}<h1>{TITLE}</h1><p>{LONG}</p><p>{MIDDLE}</p>{part}{end}<footer>{FOOT}</footer>")
    return [f"<!DOCTYPE html><html><head><title>{TITLE}</title></head><body>{p}</body></html>" for p in pages]
