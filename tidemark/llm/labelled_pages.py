"""Labelled pages for training: ``data-main`` marks the elements that are main text.

They show kinds of blocks that a sample of pages may lack. The words are invented.
"""

_NEWS = """<html><head><title>Harbour opens</title></head><body>
<header class="site-header"><a href="/">The Daily Sample</a><p>Your paper since 1971</p></header>
<nav class="menu"><ul><li><a href="/a">World</a></li><li><a href="/b">Sport</a></li><li><a href="/c">Culture</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better. By going on you agree to them.</p><button>Accept</button></div>
<main><article data-main><h1>Harbour opens after long repair</h1>
<p>The old harbour has opened again, and the first ships came in at dawn on Monday. Many people stood on the pier.</p>
<p>Work had taken three years. It was paid for by the town and by the owners of the boats, who say that it was worth it.</p>
<h2>What comes next</h2><p>A new market hall is planned.</p>
<ul><li>It will have room for forty stands.</li><li>Building starts in spring.</li></ul></article>
<section class="comments"><h3>Comments</h3><div class="comment"><p>Great news, I was there on the first morning and loved it.</p></div>
<div class="comment"><p>And who pays for all of that in the end? We do, of course.</p></div></section></main>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Ten ways to cook rice</a></li><li><a href="/2">Rain in June</a></li></ul></aside>
<div class="ad"><p>Buy the new kettle today and save a lot of money.</p></div>
<footer><p>&copy; 2020 The Daily Sample. All rights reserved.</p><p><a href="/i">Imprint</a> | <a href="/p">Privacy</a></p></footer></body></html>"""

_BLOG = """<html><body><div id="top"><a href="/">Home</a> <a href="/about">About me</a></div>
<div id="content"><div class="post" data-main><h1>Growing beans</h1><p>Beans like warm soil. I sow them in May, two at a time, and water them every evening.
<p>After a week they show. Then I put up sticks, because they climb as high as they can.
<blockquote>Never hurry a bean.</blockquote><p>My neighbour taught me that.</div>
<div class="share"><a href="#">Share this</a> <a href="#">Tweet</a></div>
<form class="newsletter"><label>Your address</label><input name="m"><p>Sign up for the letter that I send every month.</p></form>
<div id="comments"><p>I tried this last year and it worked very well for us.</p><p>Thanks for the hint!</p></div></div>
<div class="sidebar widget"><h4>Archive</h4><p><a href="/2019">2019</a></p></div>
<div id="footer">Powered by beans. Contact us at any time.</div></body></html>"""

_PLAIN = """<html><body><table><tr><td class="nav"><a href="1.html">One</a></td><td><a href="2.html">Two</a></td></tr></table>
<div class="text" data-main><h2>On walking</h2><p>Walking is the plainest of arts. You put one foot before the other, and the world comes to you.</p>
<p>Some walk to think, others so as not to think. Both are right.</p><pre>left right left</pre></div>
<div class="banner promo"><p>This week only: boots at half price in all of our shops.</p></div>
<p class="copyright">Copyright 1999 by the walkers. Updated in 2003.</p></body></html>"""

_SHORT = """<html><body><header><h2>City library</h2><nav><a href="/">Start</a><a href="/s">Search</a></nav></header>
<div class="alert notice"><p>The library is closed on Friday.</p></div>
<article data-main><h1>Opening hours</h1><p>Open from nine to five.</p></article>
<div class="related"><h3>Related</h3><p><a href="/x">How to get a card</a></p></div>
<div class="advert sponsored"><p>Sponsored: learn a language in ten days with our course.</p></div>
<form><p>Ask a question</p><select><option>Books</option><option>Films</option></select></form>
<footer class="site-footer"><div>Library of the city &middot; <a href="/c">Contact</a></div></footer></body></html>"""

_BARE = """<html><body><header><h1>Garden notes</h1><p>Notes from a small garden.</p></header><nav><a href="/">Home</a><a href="/n">Notes</a></nav>
<article data-main><h1>Frost in May</h1><p>The frost came late this year. It took the young leaves of the vine.</p><p>They will grow again, as they always do.</p></article>
<section class="comments"><p>The same happened here, in the same week.</p><p>Cover them with a sheet next time, it helps.</p></section>
<aside><p>Another note that you may like to read.</p></aside><form><p>Send me a question about plants.</p></form>
<footer><p>Written by a gardener, 2018.</p></footer></body></html>"""

_DIVS = """<html><body><div class="menu"><div><a href="/">Start</a></div><div><a href="/w">Work</a></div></div>
<div class="notice"><p>This page has moved. Please renew your link to it.</p></div>
<div class="article-body" data-main><p>Glass is sand that has been through fire. It is neither quite solid nor at all fluid.</p><p>Old panes are thicker at the foot, but not because they flow.</p></div>
<div class="comments"><div class="comment"><p>My windows are like that too, I measured them.</p></div></div>
<div class="related-posts"><p>More about sand and fire.</p></div><div class="advertisement"><p>New windows, fitted in a day. Call us now.</p></div>
<div class="footer"><p>All rights reserved.</p></div></body></html>"""

PAGES = (_NEWS, _BLOG, _PLAIN, _SHORT, _BARE, _DIVS)
