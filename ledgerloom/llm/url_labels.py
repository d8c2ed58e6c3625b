"""A small labelled table of urls, written by hand: invented hosts below reserved names, in the usual block-list kinds.

It has nothing to do with the rules of ``url_filter``: a label says what host and path are about (gambling, pills, adult
pages, trackers, link farms, cracked software, phishing) or that they are ordinary pages in several languages. Paths such as ``/en/12``, queries, ``www``
and ``blog`` stand on both sides, so that they tell nothing. 96 urls of each verdict; the table does not grow with the corpus.
"""

from __future__ import annotations

# The labelled urls, without their scheme.
BLOCK = """
casino-royale.example/slots/ www.lucky-casino.test/en/31 online-casino77.example/bonus blog.casinospin.invalid/de/204 vegas-slots.test/free-spins
slot-machines.example/jackpot/ poker-stars-bonus.test/deposit m.texas-poker.invalid/en/9 betting-tips.example/odds/today sports-bet365x.test/live
best-bets.invalid/es/77 free-betting.example/signup www.big-win-lotto.test/play winner-jackpot.example/claim roulette-king.invalid/fr/12
m.blackjack-win.test/table bingo-bonus.example/free gamble-now.test/ bookmaker-odds.invalid/en/540 scratch-and-win.example/prize
viagra-online.test/buy cheap-viagra.example/en/88 www.pills-shop.invalid/order buy-pills-now.test/discount/ pharmacy-no-prescription.example/cialis
canadian-pharma.test/en/2 m.cialis-generic.invalid/buy-cheap diet-pills-fast.example/lose-weight weight-loss-miracle.test/keto blog.xanax-cheap.example/de/3
steroids-for-sale.invalid/shop cbd-miracle-pills.test/offer male-enhancement.example/pills cheap-meds.invalid/es/41 replica-watches-cheap.test/rolex
adult-video.example/watch www.xxx-movies.test/free blog.adult-dating.invalid/en/71 hot-singles-near.example/chat porn-tube.test/video/812
m.sexcam-live.invalid/girls nude-cams.example/live adultxxx.test/fr/19 erotic-stories.example/hot escort-girls.invalid/city adult-toys-xxx.test/shop
sexy-webcam.example/en/650 free-porn-clips.invalid/new x-rated-adult.test/18plus milf-dating.example/join
ads-server.test/banner.js click-track.example/redirect?id=4 ad-tracker.invalid/pixel.gif www.popunder-ads.test/serve tracking-pixel.example/t.gif
adclick-network.invalid/go m.banner-ads.test/en/5 popup-ads.example/click affiliate-track.test/out adsyndicate.invalid/imp?zone=2
spam-links.example/en/15 link-farm.test/seo/backlinks www.seo-spam.invalid/cheap-links buy-backlinks.example/order article-spinner.test/spun/99
content-farm.example/auto/4411 doorway-pages.invalid/de/60 blog.spamblog.test/es/8 splog-network.example/post keyword-stuffing.invalid/en/777
crack-keygen.test/download warez-full.example/serial www.cracked-software.invalid/en/32 free-keygens.test/patch torrent-warez.example/iso
nulled-scripts.invalid/download m.movie-torrent-free.test/watch pirate-streams.example/live serial-crack.invalid/fr/6
secure-login-verify.test/account/update paypa1-support.example/signin bank-alert-verify.invalid/login free-gift-card.test/claim you-won-prize.example/winner
crypto-doubler.invalid/invest bitcoin-giveaway.test/send forex-profit-fast.example/rich make-money-fast.invalid/en/11 work-from-home-cash.test/earn
payday-loans-fast.example/apply instant-cash-loan.invalid/es/90 free-iphone-winner.test/survey antivirus-alert.example/download.exe
malware-cleaner-free.invalid/setup.exe cheap-essay-writing.test/order buy-followers.example/likes
"""
ALLOW = """
city-library.example/catalogue/ www.river-museum.test/en/31 open-university.example/courses blog.gardening.invalid/de/204 daily-herald.test/news/2021
weather-service.example/forecast/ school-district.test/calendar m.train-times.invalid/en/9 parliament.example/debates/today national-archive.test/records
recipes.invalid/es/77 health-ministry.example/guidelines www.mountain-club.test/routes history-society.example/journal court-decisions.invalid/fr/12
m.bird-watching.test/species chess-federation.example/results public-radio.test/ journal-of-physics.invalid/en/540 maths-forum.example/questions
docs.compiler.test/manual python-tutorials.example/en/88 www.linux-guide.invalid/install database-notes.test/index/ encyclopedia.example/wiki/physics
stadtbibliothek.test/en/2 m.wetterdienst.invalid/vorhersage universitaet.example/fakultaet zeitung.test/politik/2020 blog.kochbuch.example/de/3
bibliotheque.invalid/collection mairie.test/services musee.example/exposition lycee.invalid/es/41 observatoire.test/etoiles
universidad.example/facultad www.biblioteca.test/libros blog.cocina.invalid/en/71 periodico.example/noticias ayuntamiento.test/tramites/812
m.museo.invalid/obras escuela.example/calendario revista.test/fr/19 montana.example/rutas hospital.invalid/citas teatro.test/programa
philosophy.example/en/650 linguistics.invalid/papers astronomy.test/observations geology.example/maps
thornton.test/about.html henderson.example/contact?id=4 whitfield.invalid/index.html www.stratton.test/home ashworth.example/notes.html
kingston.invalid/events m.northern.test/en/5 eastgate.example/parish western.test/harbour hathaway.invalid/poems?page=2
letters.example/en/15 stories.test/chapter/one www.essays.invalid/reading interior.example/design reference.test/entry/99
tradition.example/folk/4411 education.invalid/de/60 blog.gathering.test/es/8 thinking.example/post restoration.invalid/en/777
statistics.test/download census-data.example/tables www.research-institute.invalid/en/32 open-data.test/datasets astronomy-club.example/iso
software-foundation.invalid/download m.film-archive.test/watch concert-hall.example/live print-history.invalid/fr/6
student-portal.test/account/update town-council.example/signin savings-bank.invalid/login science-prize.test/laureates book-prize.example/winner
economics.invalid/invest postal-service.test/send furniture.example/oak carpentry.invalid/en/11 home-and-garden.test/earth
volunteer-centre.example/apply credit-union.invalid/es/90 household-survey.test/survey text-editor.example/download.exe
map-viewer.invalid/setup.exe handwriting.test/order community.example/likes
"""


def labelled_urls() -> list[tuple[str, str]]:
    """(url, verdict) rows of the table."""
    return [("https://" + u, verdict) for verdict, urls in (("block", BLOCK), ("allow", ALLOW)) for u in urls.split()]
