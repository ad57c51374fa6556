"""Fixed word lists and parameters of the harvesting rules.

Every list below is a fixed value: results depend on these exact words, their
case and their order.
"""

from __future__ import annotations

# --- fixed values: keyword dictionaries of the extraction rules -------------

AUTHOR_COMMENT_KEYS = ["COMMENT"]
AUTHOR_FOOTER_KEYS = ["FOOTER", "SOCIAL", "SHARE", "FACEBOOK", "TWITTER"]
AUTHOR_KEYS = ["AUTHOR", "BYLINE"]
AUTHOR_DROP_TAGS = ["nav", "script", "time"]
AUTHOR_TAGS = ["span", "a", "p", "div"]

CONTENT_INVALID_KEYS = [
    "privacy", "ads", "advertisement", "newsletter", "modal", "subscription",
    "related-articles", "recommended-posts", "asset-below", "related-posts",
    "caption", "stats", "nav-links",
]
CONTENT_KEYS = ["content", "main", "article", "body"]
CONTENT_TAGS = ["article", "div"]
CONTENT_DROP_TAGS = ["script", "nav", "forms", "button", "aside", "style", "ul", "select"]

PAGE_INVALID_KEYS = [
    "privacy", "newsletter", "modal", "subscription", "related-articles",
    "recommended-posts", "asset-below", "card",
]
PAGE_DROP_TAGS = ["script", "forms", "button", "aside"]
INVALID_TITLE_PHRASES = ["page not found", "attention required!", "Página no encontrada"]

DATE_KEYS = ["DATE", "PLAT"]
DATE_DROP_TAGS = ["script"]
DATE_TAGS = ["time", "span", "a", "p", "div"]

TITLE_TAG = "title"
TITLE_TAGS = ["h1", "h2", "h3"]
TITLE_DROP_TAGS = ["script"]

HTML_CONTENT_TYPE = ["text/html"]

# --- fixed values: registry defaults and eligibility -----------------------

UNKNOWN_COUNTRY = "Unknown"
UNKNOWN_COUNTRY_CODE = "NoC"
LOCAL_COUNTRY = "Philippines"
LOCAL_SITE_TYPE = "LOCAL_NEWS"
FOREIGN_SITE_TYPE = "INTERNATIONAL_NEWS"
NEW_SITE_COST = 300.0
SITE_LANGUAGE = "Python"
ELIGIBLE_COUNTRIES = ["Philippines", "Singapore"]
EXCLUDED_FQDNS = ["philstar.com"]
ERROR_STATUS_CODES = [400, 403, 404]
MISSING_RESPONSE_STATUS = 404

# --- fixed values: domain lists (name, anchored host pattern) --------------

LAZY_SITES = [("South China Morning Post", r"www\.scmp\.com$")]
REMOVE_SITES = [
    ("Mozilla Mercurial Repo", r"hg\.mozilla\.org$"),
    ("Youtube", r"www\.youtube\.com$"),
    ("Facebook", r"www\.facebook\.com$"),
    ("Twitter", r"www\.twitter\.com$"),
]

# --- fixed values: names of the months with their short forms, by language ----

MONTH_NAMES = {
    "en": ["january jan", "february feb", "march mar", "april apr", "may", "june jun", "july jul", "august aug",
           "september sept sep", "october oct", "november nov", "december dec"],
    "es": ["enero ene", "febrero feb", "marzo mar", "abril abr", "mayo may", "junio jun", "julio jul", "agosto ago",
           "septiembre setiembre sept sep", "octubre oct", "noviembre nov", "diciembre dic"],
    "fr": ["janvier janv", "février fevrier févr fevr", "mars", "avril avr", "mai", "juin", "juillet juil", "août aout",
           "septembre sept", "octobre oct", "novembre nov", "décembre decembre déc"],
    "de": ["januar jan", "februar feb", "märz maerz mär", "april apr", "mai", "juni jun", "juli jul", "august aug",
           "september sept sep", "oktober okt", "november nov", "dezember dez"],
    "tl": ["enero", "pebrero", "marso", "abril", "mayo", "hunyo", "hulyo", "agosto", "setyembre", "oktubre",
           "nobyembre", "disyembre"],
}

# --- fixed values: quiet windows (start minute of day, length in minutes) ---

QUIET_MINUTES = 30
LINK_QUIET_WINDOWS = [(3 * 60, 30), (9 * 60, 30), (15 * 60, 30), (21 * 60, 30)]
ARTICLE_QUIET_WINDOWS = [(6 * 60, 30), (12 * 60, 30), (18 * 60, 30), (23 * 60, 90)]

# --- fixed values: queue --------------------------------------------------

QUEUED = "Queued"
PROCESSING = "Processing"
DONE = "Done"
ERROR = "Error"
SYSTEM_CREATOR = "System"
JS_CREATORS = ["JS_link", "JS_lazy"]
JS_ERROR_CREATOR = "JS_Error"

# --- fixed values: outcomes -----------------------------------------------

OUTCOME_NOT_ELIGIBLE = "Website not for scraping"
OUTCOME_DUPLICATE = "Duplicate article"
OUTCOME_NO_CONTENT = "No Content"
OUTCOME_NO_TITLE = "No Title"
OUTCOME_SCRAPED = "Article Scraped"
OUTCOME_ERROR = "Error"
#: Messages of the rendered mode.
DUPLICATE_MESSAGE = "Duplicate Article Found in Database"
NO_SOURCE_MESSAGE = "Error getting page source. Connection Timeout"

# --- fixed values: attributes whose value is a list of words ---------------

LIST_ATTRS_ANY_TAG = ["class", "accesskey", "dropzone"]
LIST_ATTRS_BY_TAG = {
    "a": ["rel", "rev"],
    "link": ["rel", "rev"],
    "td": ["headers"],
    "th": ["headers"],
    "form": ["accept-charset"],
    "object": ["archive"],
    "area": ["rel"],
    "icon": ["sizes"],
    "iframe": ["sandbox"],
    "output": ["for"],
}
VOID_TAGS = [
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
    "menuitem", "meta", "param", "source", "track", "wbr", "basefont", "bgsound",
    "command", "frame", "image", "isindex", "nextid", "spacer",
]
TEXTLESS_TAGS = ["script", "style", "template", "rt", "rp"]

# --- fixed values: stopwords -----------------------------------------------

STOPWORDS_TL = """
akin aking ako alin am amin aming ang ano anumang apat at atin ating ay bababa
bago bakit bawat bilang dahil dalawa dapat din dito doon gagawin gayunman
ginagawa ginawa ginawang gumawa gusto habang hanggang hindi huwag iba ibaba
ibabaw ibig ikaw ilagay ilalim ilan inyong isa isang itaas ito iyo iyon iyong ka
kahit kailangan kailanman kami kanila kanilang kanino kanya kanyang kapag kapwa
karamihan katiyakan katulad kaya kaysa ko kong kulang kumuha kung laban lahat
lamang likod lima maaari maaaring maging mahusay makita marami marapat masyado
may mayroon mga minsan mismo mula muli na nabanggit naging nagkaroon nais nakita
namin napaka narito nasaan ng ngayon ni nila nilang nito niya niyang noon o pa
paano pababa paggawa pagitan pagkakaroon pagkatapos palabas pamamagitan panahon
pangalawa para paraan pareho pataas pero pumunta pumupunta sa saan sabi sabihin
sarili sila sino siya tatlo tayo tulad tungkol una walang
""".split()

STOPWORDS_EN = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs themselves
what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above
below to from up down in out on off over under again further then once here there
when where why how all any both each few more most other some such no nor not
only own same so than too very s t can will just don should now d ll m o re ve y
""".split()

STOPWORDS_ES = """
a al algo algunas algunos ante antes como con contra cual cuando de del desde
donde durante e el ella ellas ellos en entre era eran es esa esas ese eso esos
esta estas este esto estos está están fue fueron ha había han hasta hay la las le
les lo los me mi mis mucho muchos muy más mí nada ni no nos nosotros nuestra
nuestro o os otra otras otro otros para pero poco por porque que quien quienes qué
se sea ser si sin sobre son su sus sí también tan tanto te tiene tienen todo todos
tu tus tú un una uno unos vosotros vuestra vuestro y ya yo él éramos
""".split()

STOPWORDS = {"en": STOPWORDS_EN, "es": STOPWORDS_ES, "tl": STOPWORDS_TL}

# --- public suffixes known by default; pass a fuller table where needed ------

_GENERIC = """
com net org edu gov mil int info biz name pro mobi asia travel jobs tel cat coop aero museum post
app dev news press media blog online site website tech store shop live world today life club xyz
top space global cloud digital agency network group email link page social studio video radio
""".split()
_COUNTRY = """
ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw
by bz ca cc cd cf cg ch ci ck cl cm cn co cr cu cv cw cx cy cz de dj dk dm do dz ec ee eg er es et
eu fi fj fk fm fo fr ga gd ge gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie
il im in io iq ir is it je jm jo jp ke kg kh ki km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv
ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc ne nf ng ni nl no np nr
nu nz om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sk sl
sm sn so sr ss st su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk us uy uz
va vc ve vg vi vn vu wf ws ye yt za zm zw
""".split()
_SECOND_LEVEL = {
    "ae": "ac co gov mil net org sch", "ar": "com edu gob int mil net org", "au": "asn com edu gov id net org",
    "bd": "ac com edu gov mil net org", "bh": "com edu gov net org", "bn": "com edu gov net org",
    "bo": "com edu gob net org", "br": "adv blog com edu eng gov ind jus leg mil net org tv",
    "cn": "ac com edu gov mil net org", "co": "com edu gov mil net nom org", "cr": "ac co ed fi go or",
    "do": "com edu gob gov mil net org", "ec": "com edu fin gob gov info mil net org", "eg": "com edu gov mil net org",
    "fj": "ac com gov info name net org", "gh": "com edu gov mil org", "gt": "com edu gob ind mil net org",
    "hk": "com edu gov idv net org", "id": "ac biz co desa go mil my net or sch web",
    "il": "ac co gov idf k12 muni net org", "in": "ac co edu firm gen gov ind mil net nic org res",
    "jo": "com edu gov mil name net org sch", "jp": "ac ad co ed go gr lg ne or",
    "ke": "ac co go info me mobi ne or sc", "kh": "com edu gov mil net org per",
    "kr": "ac co es go hs kg mil ms ne or pe re sc", "kw": "com edu gov net org", "lb": "com edu gov net org",
    "lk": "ac com edu gov net org sch", "mm": "com edu gov net org", "mo": "com edu gov net org",
    "mt": "com edu net org", "mx": "com edu gob net org", "my": "com edu gov mil name net org",
    "ng": "com edu gov mil mobi name net org sch", "np": "com edu gov mil net org",
    "nz": "ac co geek gen govt health iwi kiwi maori mil net org school", "om": "co com edu gov net org",
    "pe": "com edu gob mil net nom org", "pg": "ac com gov mil net org", "ph": "com edu gov i mil net ngo org",
    "pk": "com edu fam gov net org web", "pl": "com edu gov info net org", "pr": "com edu gov net org",
    "pt": "com edu gov org", "py": "com edu gov mil net org", "qa": "com edu gov mil net org",
    "sa": "com edu gov med net org sch", "sg": "com edu gov net org per", "sv": "com edu gob org",
    "th": "ac co go in mi net or", "tr": "av bel biz com edu gen gov info k12 mil name net org tel tv web",
    "tw": "club com ebiz edu game gov idv mil net org", "tz": "ac co go me mil ne or sc",
    "ua": "com edu gov in net org", "ug": "ac co com go ne or org sc",
    "uk": "ac co gov ltd me net nhs org plc police sch", "uy": "com edu gub mil net org",
    "ve": "co com edu gob info mil net org web", "vn": "ac biz com edu gov health info int name net org pro",
    "za": "ac co edu gov law mil net nom org school web", "zm": "ac co com edu gov net org sch", "zw": "ac co gov mil org",
}
#: Domains all of whose second levels are suffixes, and names that are not.
_ANY_SECOND_LEVEL = ["*.bd", "*.ck", "!www.ck", "*.er", "*.fk", "*.jm", "*.kh", "*.mm", "*.np", "*.pg"]
#: Rules that hold by default: generic and country domains and the usual second levels.
#: Not the whole public list; plans take a table instead.
PUBLIC_SUFFIXES = (
    _GENERIC + _COUNTRY + [f"{s}.{c}" for c, own in _SECOND_LEVEL.items() for s in own.split()] + _ANY_SECOND_LEVEL
)

KEYWORD_DICTIONARIES = {
    "author_invalid": AUTHOR_COMMENT_KEYS + AUTHOR_FOOTER_KEYS,
    "author": AUTHOR_KEYS,
    "content_invalid": CONTENT_INVALID_KEYS,
    "content": CONTENT_KEYS,
    "page_invalid": PAGE_INVALID_KEYS,
    "date": DATE_KEYS,
}


def stopwords_for(lang: str) -> list[str]:
    """Stopwords of ``lang`` together with the English ones."""
    words = list(STOPWORDS_EN)
    return words + [w for w in STOPWORDS.get(lang, []) if w not in set(words)]
