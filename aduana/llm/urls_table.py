"""The labelled URL table of the filter's model. All invented; 1 is to be blocked."""

LABELLED = [(url, 1) for url in """
http://cheap-pills.example.net/buy
https://www.cheap-pills.example.com/en/12
http://best-pills-online.example.org/order/now
https://pharmacy-discount.example.com/cheap/viagra
http://buy-meds.example.net/no-prescription
https://spam-farm.example.com/en/7
http://www.spam-farm.example.net/fr/301.html
https://seo-spam.example.org/links/page9
http://link-farm.example.net/directory/11
https://content-farm.example.com/es/88/
http://online-casino.example.com/slots
https://casino-royal.example.net/bonus?ref=9
http://free-casino-spins.example.org/jackpot
https://poker-win.example.com/bet/now
http://sports-betting.example.net/odds
https://bet-bonus.example.org/win/big
http://free-money.example.com/claim
https://win-prize.example.net/free/gift
http://get-rich-quick.example.org/cash
https://payday-loans.example.com/apply
http://instant-loan.example.net/cash/now
https://crypto-doubler.example.org/invest
http://adult-cams.example.com/live
https://xxx-videos.example.net/watch
http://hot-singles.example.org/dating/xxx
https://warez-crack.example.com/keygen
http://free-download-crack.example.net/serial
https://torrent-pirate.example.org/movies
http://replica-watches.example.com/cheap
https://fake-bags.example.net/discount/replica
http://click-here.example.org/popup/ads
https://ads-tracker.example.com/click?id=3
http://malware-update.example.net/flash/install.exe
https://phishing-login.example.org/verify/account
http://miracle-diet.example.com/lose-weight-fast
https://weight-loss-pills.example.net/buy/cheap
http://adult-chat.example.org/de/3
https://www.adult-dating.example.net/en/18
http://adult-movies.example.com/fr/5
http://free-bet-offers.example.com/en/2
https://bets-today.example.net/de/6
http://casino-club.example.net/de/4
http://ads-popup.example.org/en/1
http://crypto-invest.example.com/doubler/now
https://bitcoin-doubler.example.net/invest
http://free-crypto.example.org/claim/bonus
https://crypto-casino.example.com/bet
http://sports-bets.example.org/bonus
https://betting-odds.example.com/win
http://online-betting.example.net/bet/free
https://slots-jackpot.example.net/casino/spins
http://poker-online.example.com/slots/bonus
https://casino-bonus.example.org/en/6
http://malware-install.example.com/update.exe
https://flash-update.example.net/install/setup.exe
http://free-antivirus-update.example.org/download.exe
https://phishing-account.example.com/login/verify
http://verify-login.example.net/account/password
https://secure-account-verify.example.org/login
http://win-free-prize.example.com/claim
https://free-gift-prize.example.org/win
http://prize-claim.example.net/winner
https://popup-ads.example.com/click
http://ads-click.example.net/track
https://tracker-popup.example.com/ads/5
http://adult-webcams.example.net/live/xxx
https://adult-videos.example.org/watch
http://xxx-adult.example.com/en/44
https://hot-dating.example.net/singles
http://singles-dating.example.com/adult
https://sexy-cams.example.org/live
http://cheap-meds.example.com/order
https://online-pharmacy.example.net/pills/buy
http://viagra-cheap.example.org/buy/now
https://discount-pills.example.com/en/31
http://payday-cash.example.net/loans
https://fast-loans.example.org/apply/cash
http://cash-loan.example.com/instant
https://easy-money.example.net/rich/fast
http://get-rich-fast.example.com/money
https://cheap-replica-bags.example.org/buy
http://replica-shoes.example.net/discount
https://fake-watches.example.com/cheap
http://keygen-serials.example.org/crack
https://warez-download.example.net/serial/keygen
http://torrent-movies.example.com/free/pirate
https://pirate-downloads.example.org/torrent
http://miracle-pills.example.net/weight-loss
https://lose-weight.example.org/diet/miracle
http://seo-links.example.com/farm/backlinks
https://buy-backlinks.example.net/seo
http://link-spam.example.org/en/90
https://content-spam.example.net/de/14
http://spam-links.example.com/es/3
https://buy-followers.example.com/cheap/likes
http://cheap-followers.example.net/buy
""".split()] + [(url, 0) for url in """
https://www.library.example.org/en/catalogue
http://news.example.com/en/2024/05/story.html
https://blog.gardening.example.net/roses
http://docs.example.org/guide/install
https://en.wiki.example.org/wiki/History
http://university.example.edu/physics/course1
https://m.recipes.example.com/soup/12
http://museum.example.net/fr/collection
https://www.weather.example.com/es/madrid
http://thehouse.example.net/en/25#top
https://ther.example.org/en/685
http://anther.example.com/en/676
https://thiner.example.net/en/770
http://blog.tionand.example.com/en/853/
https://m.herou.example.com/fr/474.html
http://thanth.example.net/fr/960
https://blog.eaught.example.net/es/533/
http://ingsh.example.org/de/453
https://onder.example.com/de/148.html
http://www.thathe.example.net/de/959/
https://blog.hereon.example.com/de/327
https://ennthe.example.net/de/701
http://m.wister.example.com/de/279/
https://zeitung.example.net/de/politik
http://rathaus.example.com/de/termine
http://entre.example.net/es/797
https://www.ouvert.example.org/fr/471?page=2
http://inlyed.example.com/en/9
https://sthat.example.net/en/301
http://blog.arents.example.com/es/77/
https://m.oreaun.example.org/en/88.html
http://edanhe.example.com/en/450?page=2
https://ndering.example.org/en/728
http://cooking.example.com/pasta
https://city-council.example.org/meetings/2023
http://open-source.example.net/project/readme
https://forum.example.com/thread/4411
http://school.example.org/timetable
https://health.example.gov/vaccines
http://travel.example.net/lisbon/hotels
https://science.example.org/articles/77
http://music.example.com/concerts/june
https://football.example.net/results
http://parliament.example.org/laws/12
https://bank.example.com/accounts
http://shop.example.net/shoes/41
https://library.example.com/books/catalogue
http://public-library.example.net/en/books
https://www.university.example.org/library
http://university.example.com/courses/history
https://physics.example.edu/course/notes
http://school.example.edu/courses/physics
https://docs.example.net/guide/setup
http://docs.project.example.com/install
https://guide.example.org/docs/readme
http://project.example.org/docs/install
https://open-source.example.com/project/guide
http://wiki.example.com/wiki/Geography
https://de.wiki.example.net/wiki/Geschichte
http://fr.wiki.example.org/wiki/Histoire
https://es.wiki.example.com/wiki/Historia
http://news.example.org/2023/11/story
https://news.example.net/articles/politics
http://www.news.example.com/en/world
https://daily.example.com/news/2024/01
http://zeitung.example.com/de/sport
https://nachrichten.example.org/de/politik
http://science.example.net/articles/biology
https://journal.example.org/articles/12
http://city.example.net/council/meetings
https://council.example.com/meetings/minutes
http://parliament.example.net/debates/2023
https://laws.example.gov/parliament/acts
http://health.example.org/vaccines/schedule
https://hospital.example.com/health/contact
http://travel.example.com/rome/museums
https://hotels.example.org/travel/paris
http://museum.example.com/collection/paintings
https://art.example.net/museum/concerts
http://music.example.org/concerts/programme
https://orchestra.example.com/music/june
http://football.example.com/results/2024
https://sport.example.org/football/table
http://bank.example.net/accounts/contact
https://www.bank.example.org/branches
http://shop.example.com/books/history
https://shoes.example.org/shop/women
http://recipes.example.net/soup/tomato
https://cooking.example.org/recipes/pasta
http://blog.cooking.example.net/recipes/bread
https://gardening.example.com/roses/pruning
http://blog.example.org/gardening/2022
https://forum.example.net/thread/872
http://forum.gardening.example.org/thread/19
https://weather.example.com/madrid/today
http://weather.example.org/en/lisbon
https://school.example.net/timetable/2024
http://blog.onther.example.com/en/602
https://m.andere.example.net/de/518.html
http://eresti.example.org/es/240/
https://laient.example.net/fr/365?page=2
http://www.uncher.example.com/de/911
https://ingare.example.org/en/73
""".split()]
