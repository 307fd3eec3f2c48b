"""Labelled pages (our own) for main_text: what stands in <x-content>, but for <x-out>, is main text."""

from __future__ import annotations

LABELLED = [
    "<body><nav><ul><li><a>Home</a></li><li><a>News</a></li><li><a>About us</a></li></ul></nav><x-content><article><h1>Rain in the valley</h1>"
    "<p>It rained for nine days and the river rose above the old bridge before noon on Sunday.</p><p>People carried what they could to the"
    " church on the hill, and <b>nobody</b> was hurt in the night that followed.</p></article></x-content><footer><p>Copyright <a>the paper</a></p></footer></body>",
    "<body><div><a>Log in</a> | <a>Register</a></div><ul><li><a>Sport</a></li><li><a>Weather</a></li></ul><x-content><div><h2>How to bake bread</h2><p>Mix flour,"
    " water and salt, and leave the dough for a night in a cool place.<br>Bake it the next morning until it sounds hollow.</p><ul><li>Use a stone"
    " if you have one and heat it well before the loaf goes in.</li><li>Let it cool before you cut it.</li></ul></div></x-content><div><a>Next</a><a>Previous</a></div>"
    "<ul><li><a>Terms</a></li><li><a>Privacy</a></li><li><a>Contact</a></li></ul></body>",
    "<body><table><tr><td><a>Index</a></td><td><a>Search</a></td><td><a>Help</a></td></tr></table><x-content><p>The committee met in March and agreed on a plan"
    " for the harbour that would take ten years.</p><blockquote>We have waited long enough, said the mayor, and now we shall build.</blockquote><p>Work starts"
    " in <a>autumn</a> with the eastern wall, which the storm of last year broke in two places.</p></x-content><div><span>Share</span><a>Mail</a><a>Print</a></div></body>",
    # a newspaper
    "<body class='home page'><div id='page' class='site wrapper'><div id='masthead' class='site-header' role='banner'><a>The Courier</a></div><div class='nav navigation menu' role='navigation'>"
    "<a>World</a><a>Money</a></div><div class='breadcrumb breadcrumbs'><a>Home</a> / <a>World</a></div><div class='ad ads banner'>Buy two and pay for one</div><div id='content'"
    " class='content has-sidebar'><div class='main' role='main'><x-content><div class='article post story'><div class='article-header entry-header'><h1 class='title'>Ferry leaves late</h1></div><div class='article-body entry-content'>"
    "<p>The ferry to the islands left four hours late on Friday, after a rope had caught in one of its screws.</p><x-out><div class='ad advert'>Fly away this winter</div></x-out>"
    "<p class='text'>No one was hurt, and the company says that all tickets stay valid for a week.</p><x-out><div class='related related-posts'><a>More on ferries</a><a>Islands</a></div></x-out>"
    "<p>The next boat leaves at nine.</p></div></div></x-content><div class='share social sharing toolbar'><a>Post</a><a>Send</a></div><div id='comments' class='comments comment-list'>"
    "<div class='comment'><div class='comment-body comment-content'>I was on board and it was cold.</div><div class='reply respond'><a>Reply</a></div></div></div></div></div>"
    "<div id='sidebar' class='sidebar sidebar-content widget'><div class='widget'>Most read this week</div></div><div class='footer footer-content' role='contentinfo'>Imprint and terms</div></div></body>",
    # a blog
    "<body><div class='container'><div class='header site-header'><a>My garden</a></div><div class='menu menubar navbar nav'><a>Posts</a><a>About</a></div><div class='cookie cookies cookie-notice consent notice'>"
    "We use cookies to know you better</div><div class='layout row posts list'><div class='col left'><x-content><div class='post entry hentry'><h2 class='entry-title post-title'>Tomatoes in May</h2><div class='entry-content post-content'>"
    "<p>I put the plants outside in the second week of May, when the nights are no longer cold.</p><p class='lead'>Water them in the morning, never on the leaves.</p><div class='section story-section'>"
    "<p>By July the first of them are red, and by August there are more than we can eat.</p></div></div></div></x-content><div class='pagination pager'><a>Older</a><a>Newer</a></div>"
    "<div class='newsletter subscribe subscription signup'>Get a letter every month</div><div class='discussion feedback replies comments'><div class='comment'>Mine are still green.</div></div></div>"
    "<div class='sidebar aside rail widget'><div class='sidebar-content'>Tools</div><div class='search searchbox'>Search</div><div class='promo promotion sponsor sponsored'>Seeds from our friends</div></div></div>"
    "<div class='footer'>Made by hand. <span class='copyright'>All mine</span></div></div></body>",
    # a manual
    "<body><div class='wrapper'><div class='toolbar'><a>Log in</a></div><div class='toc nav'><a>1 Start</a><a>2 Use</a></div><div class='alert alerts'>This version is old</div><div class='main main-content'>"
    "<x-content><div class='section chapter' id='start'><h1>Start</h1><p>Press the green knob for two seconds until the lamp on the left begins to glow.</p><div class='note'>Never open the lid while it turns.</div>"
    "<pre class='code'>start slow</pre><div class='figure'><p class='caption'>The knob and the lamp, seen from above.</p></div></div><div class='section chapter' id='use'><h2>Use</h2><p>Fill it to the line"
    " and close the lid before you choose one of the five programs.</p><table class='table'><tr><td>1</td><td>slow, for wool</td></tr></table></div></x-content></div><div class='login'>Sign in to leave a remark</div>"
    "<div class='popup modal overlay'>Was this page of help?</div><div class='footer'>Printed in May</div></div></body>",
    # a forum and shop: wrappers whose names speak of two things
    "<body><div class='page'><div id='content-sidebar-wrap' class='content-sidebar-wrap'><x-content><div class='content article-wrap'><p>We tested nine lamps for a month, in two rooms and with the same books.</p>"
    "<div class='review body text'><p>The third one was the best: it is bright, it does not heat up, and it costs less than most.</p></div><x-out><div class='ad adv advertisement advertising'>Lamps from nine pounds</div>"
    "<div class='recommended recommendations'><a>Nine chairs</a></div></x-out><div class='conclusion'><p>Buy the third one, unless you need a clamp, which only the fifth has.</p></div></div></x-content>"
    "<div class='sidebar'><div class='adverts'>Books at half price</div></div></div><div class='disqus commentlist'><div class='comment'>The fifth is the best.</div></div><div class='complementary' role='complementary'>"
    "<div class='adverts ad'>Chairs</div></div><div class='gdpr consent'>Agree</div><div role='search' class='search'>Find</div></div></body>",
    "<body><div class='topbar header'><a>Shop</a></div><div class='menu'><a>Lamps</a></div><div class='content'><x-content><div class='text'><p>The old mill by the bridge was built in the year of the flood and burned twice.</p>"
    "<p>What stands there now is the third one, and its wheel is from the second.</p></div></x-content><div class='related'><a>The bridge</a></div><div class='social share'><a>Send</a></div></div>"
    "<div class='sidebar sidebar-content'><a>Map</a><div class='widget-content'>Rooms</div></div><div class='comments'>I have been there.</div><div class='ad'>Rooms with a view</div><div class='footer'>By us</div></body>",
    "<body><div class='masthead banner'>The Hill</div><div class='breadcrumbs'><a>Top</a></div><div class='container'><x-content><div class='story'><p>Snow fell on the pass for the first time since March, and the road was closed at six.</p>"
    "<x-out><div class='newsletter'>Snow by mail</div><div class='sponsored promo'>Tyres now</div><div class='share'>Send this</div></x-out><p>It may open again on Monday, if the wind turns.</p></div></x-content></div>"
    "<div class='sidebar left-sidebar'><div class='sidebar-content'><div class='ad'>Boots</div></div></div><div class='comments'><div class='comment'>We are stuck.</div></div><div class='pagination'>1 2 3</div><div class='cookie'>Fine</div><div class='notice'>Closed on Sunday</div>"
    "<div class='popup'><div class='popup-content'>Stay</div></div><div class='modal'><div class='modal-content'>Win a prize</div></div>"
    "<div class='widget'>Weather</div><div class='subscribe'>Join</div><div class='navigation'><a>Up</a></div><div class='footer copyright'>The Hill</div></body>",
    # a magazine that names blocks, elements and states
    "<body><div class='c-page__wrapper js-page'><div class='c-site-nav__list js-menu'><a>Food</a><a>Travel</a></div><div class='c-gdpr-bar c-gdpr-bar--bottom'>We and our partners keep what you read</div><div class='l-grid l-grid--wide'>"
    "<div class='l-grid__cell'><x-content><div class='c-article__body js-article'><p class='c-article__intro'>The market opens at four in the morning, long before the first train.</p><x-out><div class='c-teaser-box teaser--related'><a>Ten markets</a></div></x-out>"
    "<p>Fish comes first, then flowers, and the bread is baked in the hall behind the stalls.</p><div class='c-quote-block'>Whoever sleeps here, said the baker, sleeps at noon.</div></div></x-content><div class='reader-comments-thread'><div class='thread-item'>"
    "I know that baker.</div></div></div><div class='l-grid__cell l-grid__cell--rail'><div class='promo-box promo-box--small'>Win a weekend</div><div class='most-read-box'><a>Soup</a></div></div></div></div><div class='c-overlay popin'>Before you go</div></body>",
    # a museum: words that elsewhere name what is not content
    "<body><div class='container-fluid'><div class='navbar navbar-top'><a>Visit</a></div><x-content><div class='panel history'><div class='social-history'><p>The workers of the mill lived in two rooms each, with a kitchen for four families.</p></div>"
    "<div class='notice-board-history'><p>On the board by the gate the hours were chalked up, and the fines.</p></div><div class='header-image figure'><p class='caption'>The gate in winter.</p></div></div></x-content><div class='responses'><div class='response'>My aunt worked there.</div>"
    "</div><div class='cookie-bar'>This site keeps cookies</div><div class='footer-links'><a>Press</a></div></div></body>",
    # a town's pages
    "<body class='layout'><div class='skip-links'><a>Skip</a></div><div class='breadcrumb-trail'><a>Town</a></div><div class='page-wrapper inner'><x-content><div class='text-block'><h2>Waste and paper</h2><p>Paper is fetched on the second Tuesday of the month, from seven in the morning.</p></div>"
    "<div class='text-block info'><p>Put the bins out the night before and leave a hand's breadth between them.</p></div></x-content><div class='share-bar'><a>Send</a></div><div class='feedback-box'>Did this help you?</div><div class='tag-list tags'><a>waste</a></div></div>"
    "<div class='site-footer inner'>Town hall, open till noon</div></body>",
    # a shop
    "<body><div class='topbar-wrapper'><div class='basket'>Nothing yet</div></div><div class='product-page wrapper'><x-content><div class='product-description'><p>A kettle of steel with a handle that stays cool, for the stove and for the fire.</p><div class='details block'>"
    "<p>It holds two litres and whistles when they boil.</p></div></div></x-content><div class='upsell-block'><a>Cups</a></div><div class='related-products block'><a>Pans</a></div><div class='user-reviews reviews-list'><div class='user-review'>Mine whistles too soon.</div></div>"
    "<div class='newsletter-box signup-box'>Ten off the next one</div><div class='cookie-bar-wrapper'><div class='inner'>Accept all</div></div></div></body>",
]
#: Pages that nothing is learned from: they measure what was.
HELD_OUT = [
    "<body><div class='site-wrapper'><div class='cookie-banner-wrapper'>We store what you do</div><div class='menu-bar'><a>News</a></div><x-content><div class='article-content js-body'><p>The bridge is open again after two years.</p>"
    "<x-out><div class='promo-teaser'>Read us for a month</div></x-out><p class='intro'>Lorries must still go round.</p></div></x-content><div class='related-links'><a>Roads</a></div><div class='comment-thread'>At last.</div><div class='footer-bar'>Us</div></div></body>",
    "<body class='page'><div class='header-wrapper'><a>Home</a></div><div class='grid inner'><x-content><div class='entry story-body'><h1 class='entry-title'>Bees on the roof</h1><p>Four hives stand above the library.</p><div class='info-block'><p>The honey is sold in June.</p></div></div></x-content>"
    "<div class='sidebar-box widget'>Weather</div><div class='social-bar share'><a>Send</a></div><div class='responses-list'>Sweet.</div></div><div class='newsletter-overlay popin'>Stay a while</div></body>",
]
