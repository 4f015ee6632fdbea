"""Labelled pages the HTML model is trained on.

`data-main` marks an element as main text (1) or not (0); what is inside inherits the mark; text
outside any element, or right in html or body, is main text. The pages are written for this
purpose: the layouts web pages commonly have, in a few words each.
"""

_P = "The river rose during the night, and by morning the lower road had gone under water, so the village waited."
_Q = "Most of the crew agreed that the second design, though heavier, would be easier to mend at sea."
_R = "In the end they kept the old lamp, because it had served them well for thirty years and nobody disliked it."
_S = "She wrote down every reading, compared it with the one before, and drew a short line under each week."
_L = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Contact</a></li></ul>'

PAGES = [
    f'<html><body data-main="0"><header><h1>Daily Post</h1></header><nav>{_L}</nav><article data-main="1"><h1>Flood</h1><p>{_P}</p><p>{_Q}</p><p>Yes.</p><p>{_R}</p></article><footer>&copy; 2020 Daily Post. All rights reserved.</footer></body></html>',
    f'<html><body data-main="0"><div id="menu">{_L}</div><div class="ad">Buy two lamps, get one free.</div><div id="content" data-main="1"><h2>Lamps</h2><p>{_R}</p><p>{_S}</p></div><div class="sidebar"><h3>Related</h3>{_L}</div><div id="footer">Imprint | Terms</div></body></html>',
    f'<html><body data-main="0"><nav>{_L}</nav><div class="ad">{_Q}</div><article data-main="1"><h1>{_S}</h1><p><b>{_S}</b><br></p><p>{_P}</p><p>Of.</p></article><footer>site.example &middot; {_R}</footer></body></html>',
    f'<html><body data-main="0"><div class="cookie-notice"><p>We use cookies to improve this site.</p><button>Accept</button></div><main data-main="1"><h1>Readings</h1><p>{_S}</p><blockquote><p>{_Q}</p></blockquote><ol><li>{_P}</li><li>{_R}</li></ol></main><section data-main="0" class="comments"><h3>Comments</h3><div class="comment"><p>Great article, thanks a lot for it!</p></div><div class="comment"><p>{_Q}</p></div></section><footer><p>Contact us</p></footer></body></html>',
    f'<html><body data-main="0"><div class="header"><a href="/">Logo</a></div><div class="post" data-main="1"><h1 class="title">Design</h1><div class="entry-content"><p>{_Q}</p><p>{_R}</p><h2>Later</h2><p>{_P}</p></div></div><div class="share">Share: <a href="#">one</a> <a href="#">two</a></div><form><label>Your mail</label><input></form><aside><h4>Popular</h4>{_L}</aside></body></html>',
    f'<html><body data-main="0"><table><tr><td class="nav">{_L}</td><td data-main="1"><h2>Notes</h2><p>{_S}</p><p>{_P}</p></td><td class="side"><a href="/x">Advert</a></td></tr></table></body></html>',
    f'<html><body data-main="0"><header class="site-header"><p>The paper for the whole valley, every single day of the year.</p></header><article data-main="1"><header data-main="1"><h1>Valley</h1></header><section><p>{_P}</p><ul><li>Bread, salt and oil.</li><li>Two good ropes.</li></ul><p>{_Q}</p></section><aside data-main="0" class="related"><h4>Read more</h4>{_L}</aside><p>{_R}</p><footer data-main="0">Filed under <a href="/t">water</a></footer></article><div id="comments"><p>I was there and saw it all happen.</p><p>{_S}</p></div></body></html>',
    f'<html><body data-main="0"><div class="banner advert"><p>{_S}</p></div><div class="breadcrumb"><a href="/">Home</a> / <a href="/n">News</a></div><div class="article-body" data-main="1"><p>{_P}</p><p>{_P}</p><figure><figcaption>The lower road at noon.</figcaption></figure><table><tr><th>Week</th><th>Level</th></tr><tr><td>1</td><td>2.5</td></tr></table><pre>a = 1</pre></div><div class="newsletter"><form><p>Sign up for our newsletter.</p></form></div><div class="footer"><p>All rights reserved, 2019.</p></div></body></html>',
    f'<html><body data-main="0"><aside class="sidebar"><div class="widget"><h3>Archive</h3>{_L}</div><div class="ad"><p>{_Q}</p></div></aside><article data-main="1"><h1>Lamp</h1><p>{_R}</p><p>{_S}</p><p>{_Q}</p></article><section class="comments"><article data-main="0" class="comment"><p>{_P}</p></article><form><textarea></textarea></form></section></body></html>',
    f'<html><body data-main="0"><div class="alert notice"><p>This page has moved to a new address.</p></div><nav class="menu">{_L}</nav><div class="main"><div data-main="1" class="text"><h1>Sea</h1><p>{_Q}</p><dl><dt>Ship</dt><dd>{_R}</dd></dl></div></div><footer><nav>{_L}</nav><p>Terms of use and privacy</p></footer></body></html>',
    f'<html><body data-main="0"><div id="header"><p>Welcome</p></div><div id="main"><article data-main="1"><p>{_P}<p>{_S}<p>{_R}</article><div class="promo sponsored"><p>{_S}</p></div></div><div id="nav">{_L}</div></body></html>',
    f'<html><body data-main="0"><nav>{_L}</nav><article data-main="1"><h1>Ok</h1><p>Of.</p><p>The.</p><p>{_Q}</p><p>In the end.</p></article><div class="comments"><ul><li><p>{_R}</p></li><li><p>So true.</p></li></ul></div><div class="social">Follow us</div><footer>&copy; {_Q}</footer></body></html>',
    f'<html><body data-main="0"><nav>{_L}</nav><div class="ad">{_P}</div><article data-main="1"><h1>The lamp.</h1><p><b>The lamp.<br></article><footer>&copy; {_S}</footer></body></html>',
    f'<html><body data-main="0"><nav>{_L}</nav><div class="ad">{_S}</div><article data-main="1"><h1>Bread and salt and oil for all of them.</h1><p>Of.</p></article><footer>&copy; {_P}</footer></body></html>',
    f'<html><body data-main="0"><header>{_L}</header><main data-main="1"><p>It rained.</p></main><aside><p>{_Q}</p></aside></body></html>',
    f'<html><body data-main="0"><div class="topbar">{_L}</div><div class="content" data-main="1"><p>No news today</p></div><div class="footer">{_R}</div></body></html>',
    f"{_P}\n\n{_Q}",
    f'<nav>{_L}</nav>{_R} <b>{_S}</b> {_Q}<p data-main="1">{_P}</p><footer>Imprint</footer>',
    f"{_S}<br>{_R}",
    f'<html><body data-main="0"><p data-main="1">{_P}</p><p data-main="1">{_Q}</p></body></html>',
    f'<html><body data-main="0">{_R}<br>{_S}</body></html>',
]
