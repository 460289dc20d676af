"""Browser, operating system and device family of a user-agent text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.numbers import as_column

DEFAULT_FAMILY = "Other"

# Fixed values: (family, texts that must all occur), first rule that fits wins.
BROWSER_RULES = [
    ("Googlebot-Image", ("Googlebot-Image",)),
    ("Googlebot-Mobile", ("Googlebot-Mobile",)),
    ("Googlebot", ("Googlebot",)),
    ("Mediapartners-Google", ("Mediapartners-Google",)),
    ("bingbot", ("bingbot",)),
    ("msnbot-media", ("msnbot-media",)),
    ("Yahoo! Slurp", ("Yahoo! Slurp",)),
    ("YandexImages", ("YandexImages",)),
    ("YandexBot", ("YandexBot",)),
    ("Baiduspider", ("Baiduspider",)),
    ("Sogou web spider", ("Sogou web spider",)),
    ("Sosoimagespider", ("Sosoimagespider",)),
    ("Sosospider", ("Sosospider",)),
    ("YodaoBot", ("YodaoBot",)),
    ("MJ12bot", ("MJ12bot",)),
    ("Exabot", ("Exabot",)),
    ("discobot", ("discobot",)),
    ("ia_archiver", ("ia_archiver",)),
    ("Purebot", ("Purebot",)),
    ("SiteBot", ("SiteBot",)),
    ("VoilaBot", ("VoilaBot",)),
    ("NE Crawler", ("NE Crawler",)),
    ("ichiro", ("ichiro",)),
    ("HuaweiSymantecSpider", ("HuaweiSymantecSpider",)),
    ("Yeti", ("Yeti/",)),
    ("ezooms.bot", ("ezooms.bot",)),
    ("Wget", ("Wget",)),
    ("libwww-perl", ("libwww-perl",)),
    ("Python-urllib", ("Python-urllib",)),
    ("Java", ("Java/",)),
    ("Opera Mini", ("Opera Mini",)),
    ("Opera", ("Opera",)),
    ("Opera", ("OPR/",)),
    ("UC Browser", ("UCBrowser",)),
    ("UC Browser", ("UCWEB",)),
    ("QQ Browser Mobile", ("MQQBrowser",)),
    ("QQ Browser", ("QQBrowser",)),
    ("Sogou Explorer", ("MetaSr",)),
    ("Baidu Browser", ("baidubrowser",)),
    ("Baidu Browser", ("BIDUBrowser",)),
    ("Baidu Explorer", ("FlyFlow",)),
    ("Edge", ("Edg/",)),
    ("Edge", ("Edge/",)),
    ("Amazon Silk", ("Silk/",)),
    ("Midori", ("Midori",)),
    ("Flock", ("Flock/",)),
    ("IE Mobile", ("IEMobile",)),
    ("Maxthon", ("Maxthon",)),
    ("Avant", ("Avant Browser",)),
    ("MyIE2", ("MyIE2",)),
    ("AOL", ("AOL ",)),
    ("Chrome Frame", ("chromeframe",)),
    ("Zune", ("Zune",)),
    ("IE", ("MSIE ",)),
    ("IE", ("Trident/",)),
    ("SeaMonkey", ("SeaMonkey/",)),
    ("Iceweasel", ("Iceweasel/",)),
    ("Pale Moon", ("PaleMoon/",)),
    ("Netscape", ("Netscape/",)),
    ("Epiphany", ("Epiphany/",)),
    ("Firefox Mobile", ("Mobile", "Firefox/")),
    ("Firefox", ("Firefox/",)),
    ("RockMelt", ("RockMelt/",)),
    ("Chromium", ("Chromium/",)),
    ("Chrome Mobile iOS", ("CriOS/",)),
    ("Chrome Mobile", ("Chrome/", "Mobile Safari/")),
    ("Chrome", ("Chrome/",)),
    ("Konqueror", ("Konqueror",)),
    ("Rekonq", ("rekonq",)),
    ("BlackBerry", ("BlackBerry",)),
    ("Android", ("Android", "AppleWebKit")),
    ("Mobile Safari", ("Mobile/", "Version/", "Safari/")),
    ("Mobile Safari UI/WKWebView", ("Mobile/", "AppleWebKit")),
    ("Safari", ("Safari/",)),
    ("Apple Mail", ("Macintosh", "AppleWebKit")),
    ("CFNetwork", ("CFNetwork",)),
]
OS_RULES = [
    ("Windows Phone", ("Windows Phone",)),
    ("Windows CE", ("Windows CE",)),
    ("Windows NT 4.0", ("Windows NT 4.0",)),
    ("Windows", ("Windows",)),
    ("Android", ("Android",)),
    ("iOS", ("iPhone",)),
    ("iOS", ("iPad",)),
    ("iOS", ("iPod",)),
    ("Chrome OS", ("CrOS",)),
    ("Mac OS X", ("Mac OS X",)),
    ("Mac OS X", ("Macintosh",)),
    ("BlackBerry Tablet OS", ("RIM Tablet OS",)),
    ("BlackBerry OS", ("BlackBerry",)),
    ("Bada", ("Bada/",)),
    ("Symbian OS", ("Symbian",)),
    ("BREW", ("BREW",)),
    ("Ubuntu", ("Ubuntu",)),
    ("Debian", ("Debian",)),
    ("Fedora", ("Fedora",)),
    ("FreeBSD", ("FreeBSD",)),
    ("Linux", ("Linux",)),
]
DEVICE_RULES = [
    ("Spider", ("bot",)),
    ("Spider", ("spider",)),
    ("Spider", ("Slurp",)),
    ("iPad", ("iPad",)),
    ("iPod", ("iPod",)),
    ("iPhone", ("iPhone",)),
    ("BlackBerry", ("BlackBerry",)),
    ("Generic Smartphone", ("Android", "Mobile")),
    ("Generic Tablet", ("Android",)),
    ("Generic Smartphone", ("Windows Phone",)),
    ("Generic Smartphone", ("Symbian",)),
    ("Mac", ("Macintosh",)),
]


def family(agent: Column | str, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The family of the first rule whose texts all occur in the agent, else `Other`.

    Plain substring tests in one CASE expression: no lookup join, no Python. Callers count equal
    agents first where they can, so a rule runs once per distinct agent and group.
    """
    text = as_column(agent)
    choice = None
    for name, parts in rules:
        fits = reduce(lambda left, right: left & right, [text.contains(part) for part in parts])
        choice = F.when(fits, name) if choice is None else choice.when(fits, name)
    return F.lit(DEFAULT_FAMILY) if choice is None else choice.otherwise(DEFAULT_FAMILY)


def browser(agent: Column | str) -> Column:
    return family(agent, BROWSER_RULES)


def operating_system(agent: Column | str) -> Column:
    return family(agent, OS_RULES)


#: An Android agent names its model between a semicolon and the build.
ANDROID_MODEL = r";\s*([^;()]+?)\s+Build/"


def device(agent: Column | str) -> Column:
    """The model that an Android agent names, unless it is a spider; for all others the family of the rules."""
    text = as_column(agent)
    known = family(text, DEVICE_RULES)
    model = F.regexp_extract(text, ANDROID_MODEL, 1)
    return F.when((known != "Spider") & text.contains("Android") & (model != ""), model).otherwise(known)
