"""Text rules as Columns (family F). Regular expressions are Java's; classes such as \\w are ASCII, as in the oracle."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(c: Column, values: dict) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), c)


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalised(c: Column) -> Column:
    """lower case, without possessives and apostrophes, white space collapsed."""
    return squeezed(F.replace(F.replace(F.lower(c), F.lit("'s"), F.lit("")), F.lit("'"), F.lit("")))


# Names of positions and their codes; a code stands for itself unless listed.
POSITION_NAMES = {
    "QUARTERBACK": "QB", "QB": "QB", "RUNNING BACK": "RB", "RUNNINGBACK": "RB", "HALFBACK": "RB", "HALF BACK": "RB", "RB": "RB", "HB": "RB",
    "WIDE RECEIVER": "WR", "WIDERECEIVER": "WR", "RECEIVER": "WR", "WR": "WR", "TIGHT END": "TE", "TIGHTEND": "TE", "TE": "TE",
    "OFFENSIVE LINEMAN": "OL", "OFFENSIVE LINE": "OL", "OFFENSIVELINEMAN": "OL", "OFFENSIVE TACKLE": "OT", "OFFENSIVETACKLE": "OT",
    "LEFT TACKLE": "OT", "RIGHT TACKLE": "OT", "GUARD": "G", "OFFENSIVE GUARD": "G", "LEFT GUARD": "G", "RIGHT GUARD": "G", "CENTER": "C",
    "OT": "OT", "OG": "G", "OL": "OL", "G": "G", "C": "C", "DEFENSIVE LINEMAN": "DL", "DEFENSIVE LINE": "DL", "DEFENSIVELINEMAN": "DL",
    "DEFENSIVE END": "DE", "DEFENSIVEEND": "DE", "DEFENSIVE TACKLE": "DT", "DEFENSIVETACKLE": "DT", "NOSE TACKLE": "NT", "NOSETACKLE": "NT",
    "EDGE": "EDGE", "EDGE RUSHER": "EDGE", "DL": "DL", "DE": "DE", "DT": "DT", "NT": "NT", "LINEBACKER": "LB", "INSIDE LINEBACKER": "LB",
    "OUTSIDE LINEBACKER": "LB", "MIDDLE LINEBACKER": "LB", "LB": "LB", "ILB": "LB", "OLB": "LB", "MLB": "LB", "CORNERBACK": "CB", "CORNER BACK": "CB",
    "CORNER": "CB", "SAFETY": "S", "FREE SAFETY": "S", "STRONG SAFETY": "S", "DEFENSIVE BACK": "DB", "CB": "CB", "S": "S", "FS": "S", "SS": "S", "DB": "DB",
    "KICKER": "K", "PLACEKICKER": "K", "PUNTER": "P", "LONG SNAPPER": "LS", "LONGSNAPPER": "LS", "KICK RETURNER": "KR", "PUNT RETURNER": "PR",
    "K": "K", "P": "P", "LS": "LS", "KR": "KR", "PR": "PR",
}


def position_code(c: Column) -> Column:
    """a position's code; unknown text stays, upper-cased."""
    up = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.coalesce(lookup(up, POSITION_NAMES), up)


# Patterns of sentences that are not about the story (bylines, navigation, advertising).
NOT_STORY = [
    r"\b(is a|is an)\b.{0,30}\b(reporter|writer|journalist|correspondent|analyst|contributor|editor|columnist)\b.{0,20}\b(for|at|with)\b.{0,20}\b(espn|nfl\.com|cbs|fox|nbc)",
    r"\b(reporter|writer|journalist|correspondent|analyst|contributor|editor|columnist)\b.{0,20}\b(for|at|with)\b.{0,20}\b(espn|nfl\.com|cbs|fox|nbc)",
    r"\b(senior|national|lead|staff)\b.{0,20}\b(reporter|writer|journalist|correspondent|analyst)",
    r"\b(covers|covering)\b.{0,50}\b(at espn|for espn|at nfl\.com|for nfl\.com)",
    r"\b(covers|covering)\b.{0,20}\b(beat|nfl|sports)",
    r"\bcovers\b.{0,20}\b(entire league|whole league|league-wide)",
    r"\bcovered the\b.{0,30}\b(for more than|since \d{4})",
    r"\b(joining|joined)\b.{0,20}\b(espn|nfl\.com|cbs|fox|nbc)",
    r"\bassists with\b.{0,30}\b(coverage|draft|reporting)",
    r"\bcontributes to\b.{0,50}\b(espn|nfl live|get up|sportscenter|countdown|radio)",
    r"\bis (the )?author of\b",
    r"\bis (the )?co-author of\b",
    r"\bauthor of two published novels\b",
    r"\bmember of the\b.{0,50}\b(board of selectors|hall of fame|association)",
    r"\b(follow|contact).{0,20}\b(twitter|facebook|instagram|linkedin|email)",
    r"\b(follow|subscribe|sign up|join|get).{0,30}\b(newsletter|updates|alerts)",
    r"@\w+",
    r"\b(like|share|comment|retweet)\b",
    r"\b(click here|read more|view all|see also|related stories)",
    r"\b(photo credit|image courtesy|getty images)",
    r"\b(copyright|©|all rights reserved)",
    r"\b(terms of service|privacy policy)",
    r"\b(advertisement|sponsored|promoted)\b",
    r"\b(download|install) (app|application)",
    r"^\w{1,3}$",
]
SHORTEST_FACT = 15
# For each of the patterns above, texts of which it needs one.
NEEDED = [
    ["espn", "nfl.com", "cbs", "fox", "nbc"], ["espn", "nfl.com", "cbs", "fox", "nbc"], ["senior", "national", "lead", "staff"], ["at espn", "for espn", "at nfl.com", "for nfl.com"], ["covers", "covering"],
    ["entire league", "whole league", "league-wide"], ["covered the"], ["espn", "nfl.com", "cbs", "fox", "nbc"], ["assists with"], ["contributes to"], ["author of"], ["co-author of"], ["author of two published novels"], ["member of the"],
    ["twitter", "facebook", "instagram", "linkedin", "email"], ["newsletter", "updates", "alerts"], ["@"], ["like", "share", "comment", "retweet"], ["click here", "read more", "view all", "see also", "related stories"],
    ["photo credit", "image courtesy", "getty images"], ["copyright", "©", "all rights reserved"], ["terms of service", "privacy policy"], ["advertisement", "sponsored", "promoted"], [" app"],
]


def _not_story(low: Column) -> Column:
    """Whether a pattern fits. One is tried only where a text that it needs is held; the last needs none."""
    held = lambda words: reduce(Column.__or__, (F.contains(low, F.lit(w)) for w in words))
    return reduce(Column.__or__, (held(words) & low.rlike(pattern) for words, pattern in zip(NEEDED, NOT_STORY)), low.rlike(NOT_STORY[-1]))


def either(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def is_story_fact(c: Column) -> Column:
    """long enough, and no pattern of other content."""
    return F.coalesce((F.length(c) >= SHORTEST_FACT) & ~once(F.lower(c), _not_story), F.lit(False))


# Patterns of paragraphs that are advertising or player controls.
NOT_PARAGRAPH = [
    r"subscribe now", r"sign up for our newsletter", r"advertisement", r"cookie policy", r"keyboard shortcuts?\s*(enabled|disabled)", r"volume \d+%", r"<iframe\s+src=", r"jwplayer|jwplatform",
    r"^\d+ seconds of \d+ seconds", r"^(fullscreen|decrease|increase)\s+(caption|volume)", r"^link(https?://|copied)", r"^embed<", r"frameborder=", r"cdn\.jwplayer\.com", r"^\d{1,2}:\d{2}",
]
SHORTEST_PARAGRAPH = 20


def clean_paragraphs(c: Column) -> Column:
    """trimmed paragraphs that are long enough and no advertising."""
    keep = lambda p: (F.length(p) >= SHORTEST_PARAGRAPH) & ~F.lower(p).rlike(either(NOT_PARAGRAPH))
    return F.filter(F.transform(F.array_compact(c), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), keep)


def distinct_paragraphs(c: Column) -> Column:
    """the first of equal paragraphs, white space collapsed."""
    return F.array_distinct(F.transform(F.filter(c, lambda p: p.isNotNull() & (p != "")), squeezed))


# Topic categories.
TOPICS = [
    "Quarterback Performance & Analysis", "Running Back & Rushing Game", "Wide Receiver & Passing Game", "Defense & Turnovers", "Coaching & Play Calling", "Injuries & Player Health",
    "Team Performance & Trends", "Season Outlook & Predictions", "Rookies & Emerging Players", "Draft & College Prospects", "Trades, Signings & Roster Moves", "Contracts & Cap Management",
    "Game Analysis & Highlights", "Statistics & Rankings", "Fantasy Football Impact", "Offseason & Training Camp", "Special Teams & Kicking Game", "Refereeing & Rules",
    "Player Profiles & Interviews", "Team Culture & Leadership", "League News & Administration", "Off-Field & Lifestyle", "Media & Fan Reactions", "Non American Football Topic",
]


def topic_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(F.lower(F.trim(c)), F.lit("&"), F.lit("and")), r"[^a-z0-9]+", " "))


def topic_category(c: Column) -> Column:
    """the listed category that a label means, lower-cased, or null."""
    import re

    keys = {re.sub(r"[^a-z0-9]+", " ", t.lower().replace("&", "and")).strip(): t.lower() for t in TOPICS}
    return lookup(topic_key(c), keys)


# The first rule whose fragment a topic holds gives its key.
TOPIC_RULES = [
    ("injury", ["injur"]), ("trade", ["trade", "roster move", "signing"]), ("contract", ["contract", "cap"]), ("gameday", ["game", "highlight", "matchup", "gameday", "week"]),
    ("rumor", ["rumor"]), ("draft", ["draft", "prospect"]), ("fantasy", ["fantasy"]), ("season_outlook", ["season", "prediction"]), ("offseason", ["offseason", "training"]),
    ("culture", ["culture", "leadership"]), ("profile", ["profile", "interview"]), ("defense", ["defense", "turnover"]), ("offense", ["offense", "quarterback", "passing"]), ("league", ["league"]),
]


def canonical_topic(c: Column) -> Column:
    """F16: a topic's key by ordered rules, else its words joined by underscores."""
    low = F.lower(F.trim(c))
    out = F.replace(low, F.lit(" "), F.lit("_"))
    for key, parts in reversed(TOPIC_RULES):
        out = F.when(low.rlike("|".join(parts)), key).otherwise(out)
    return F.when(c.isNull() | (c == ""), "unknown").otherwise(out)


# The types of entities.
ENTITY_TYPES = ["player", "team", "game"]


def clean_mention(c: Column) -> Column:
    """a mention without a leading type word; null where nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.trim(c), r"(?i)^(players?:|teams?:|game:|matchup:)", "")), F.lit(""))


def entity_key(entity_id: Column, matched: Column, mention: Column) -> Column:
    """what two mentions of one entity share."""
    source = F.coalesce(F.nullif(entity_id, F.lit("")), F.nullif(matched, F.lit("")), F.nullif(mention, F.lit("")), F.lit("unknown"))
    return F.coalesce(F.nullif(F.lower(F.trim(source)), F.lit("")), F.lit("unknown"))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def normal_url(url: Column) -> Column:
    """scheme and host lower-cased, a bare host gets a slash; null where it is no URL."""
    trimmed = F.trim(url)
    scheme, authority, rest = (F.regexp_extract(trimmed, r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#\s]+)([^\s]*)$", i) for i in (1, 2, 3))
    made = F.concat(F.lower(scheme), F.lit("://"), F.lower(authority), F.when(rest.rlike("^[/]"), rest).otherwise(F.concat(F.lit("/"), rest)))
    return F.when(trimmed.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+[^\s]*$"), made)


def valid_url(url: Column) -> Column:
    """http or https with a host."""
    return F.coalesce(url.rlike(r"^https?://[^/?#]+"), F.lit(False))


def league_url(url: Column) -> Column:
    """a path segment nfl, or the league's own host."""
    h = host(url)
    return F.coalesce(F.lower(url).rlike(r"/nfl(/|$)") | (h == "nfl.com") | h.endswith(".nfl.com"), F.lit(False))


def amp_url(url: Column) -> Column:
    """an amp path."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path.endswith("/amp") | F.contains(path, F.lit("/amp/")), F.lit(False))


# Hosts whose pages need a browser.
HEAVY_HOSTS = [
    "www.espn.com", "www.nfl.com", "sports.yahoo.com", "www.cbssports.com", "www.nbcsportsphiladelphia.com", "www.nbcsportschicago.com", "www.nbcsportsbayarea.com", "www.nbcsportsboston.com",
    "www.nbcsportswashington.com",
]


def route(url: Column) -> Column:
    """which extractor a URL needs."""
    return F.when(host(url).isin(*HEAVY_HOSTS), "heavy").otherwise("light")


# Trust in sources by host.
TRUSTED = {
    "apnews.com": 1.0, "reuters.com": 1.0, "afp.com": 0.95, "nfl.com": 1.0, "nflcdn.com": 1.0, "espn.com": 1.0, "si.com": 0.80, "bleacherreport.com": 0.80, "profootballtalk.com": 1.0, "sbnation.com": 0.78,
    "on3.com": 0.75, "yahoo.com": 0.75, "sports.yahoo.com": 0.78, "cbssports.com": 1.0, "nbcsports.com": 1.0, "foxsports.com": 1.0, "sportingnews.com": 0.75, "usatoday.com": 1.0, "theringer.com": 0.75,
    "theathletic.com": 1.0, "static.clubs.nfl.com": 0.90, "azcardinals.com": 1.0, "atlantafalcons.com": 1.0, "baltimoreravens.com": 1.0, "buffalobills.com": 1.0, "panthers.com": 1.0, "chicagobears.com": 1.0,
    "bengals.com": 1.0, "clevelandbrowns.com": 1.0, "dallascowboys.com": 1.0, "denverbroncos.com": 1.0, "detroitlions.com": 1.0, "packers.com": 1.0, "houstontexans.com": 1.0, "colts.com": 1.0, "jaguars.com": 1.0,
    "chiefs.com": 1.0, "raiders.com": 1.0, "chargers.com": 1.0, "therams.com": 1.0, "miamidolphins.com": 1.0, "vikings.com": 1.0, "patriots.com": 1.0, "neworleanssaints.com": 1.0, "giants.com": 1.0,
    "newyorkjets.com": 1.0, "philadelphiaeagles.com": 1.0, "steelers.com": 1.0, "49ers.com": 1.0, "seahawks.com": 1.0, "buccaneers.com": 1.0, "titansonline.com": 1.0, "commanders.com": 1.0,
    "commons.wikimedia.org": 0.75, "upload.wikimedia.org": 0.75, "nytimes.com": 0.95, "newyorker.com": 0.95, "washingtonpost.com": 0.95, "latimes.com": 0.90, "wsj.com": 0.95, "bloomberg.com": 0.80,
    "cnn.com": 1.0, "foxnews.com": 1.0, "nbcnews.com": 1.0, "abcnews.go.com": 0.75, "cbsnews.com": 0.75,
}
UNTRUSTED = {"blogspot.com": 0.2, "wordpress.com": 0.3, "medium.com": 0.3, "tumblr.com": 0.2, "pinterest.com": 0.1, "reddit.com": 0.2, "i.redd.it": 0.2}
SUBDOMAIN_SHARE, NEUTRAL = 0.9, 0.5


def source_score(domain: Column) -> Column:
    """trust in a host: listed, a sub-domain of a listed one (a tenth less where trusted), else neutral. Only the prefix www. is dropped (K6)."""
    h = F.regexp_replace(F.lower(domain), r"^www\.", "")
    labels = F.split(h, r"\.")
    parents = F.transform(F.sequence(F.lit(2), F.greatest(F.size(labels), F.lit(2))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    exact = F.coalesce(lookup(h, TRUSTED), lookup(h, UNTRUSTED))
    first = lambda values: F.get(F.array_compact(F.transform(parents, lambda p: lookup(p, values))), F.lit(0))
    return F.coalesce(exact, first(TRUSTED) * SUBDOMAIN_SHARE, first(UNTRUSTED), F.lit(NEUTRAL))


def sentences(c: Column) -> Column:
    """parts that end with . ! or ? and white space."""
    parts = F.split(F.replace(c, F.lit("\n"), F.lit(" ")), r"(?<=[.!?])\s+")
    return F.filter(F.transform(parts, lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")), lambda s: s != "")


# Words that tell the kind of a sentence.
ROSTER_WORDS = ["signed", "waived", "traded", "activated", "injury", "lineup", "starter", "rookie"]
EVENT_WORDS = ["win", "loss", "defeat", "victory", "matchup", "playoff", "game", "tournament", "final"]
STATISTIC_WORDS = ["points", "yards", "touchdowns", "rebounds", "assists", "sacks", "interceptions", "goals"]


def holds_any(c: Column, words: list[str]) -> Column:
    return c.rlike("|".join(map(re.escape, words))) if words else F.lit(False)


def sentence_kind(c: Column, team_words: list[str]) -> Column:
    """quote, roster, event, statistic, factual or generic; the first that fits."""
    low, number, team = F.lower(c), c.rlike(r"\d"), holds_any(F.lower(c), [w.lower() for w in team_words])
    return (
        F.when(c.rlike('“[^”]+”|"[^"]+"'), "quote")
        .when(team & holds_any(low, ROSTER_WORDS), "roster")
        .when(team & holds_any(low, EVENT_WORDS), "event")
        .when(number & holds_any(low, STATISTIC_WORDS), "statistic")
        .when(number | team, "factual")
        .otherwise("generic")
    )


def once(c: Column, fn) -> Column:
    """fn(c), with c computed once however often fn, or a lambda in it, names it."""
    return F.get(F.transform(F.array(c), fn), F.lit(0))


def capitalised(words: Column) -> Column:
    """capitalised words and the pairs they end, distinct in order, longer than two characters."""
    bare = F.filter(F.transform(words, lambda w: F.regexp_replace(w, "^[,.!?:;()\\[\\]{}\"'’-]+|[,.!?:;()\\[\\]{}\"'’-]+$", "")), lambda w: w != "")
    upper = lambda w: w.substr(1, 1).rlike(r"^\p{Lu}")

    def named(held: Column) -> Column:
        return F.transform(held, lambda w, i: F.when(upper(w), F.array(F.when(i > 0, F.concat(F.get(held, i - 1), F.lit(" "), w)), w)).otherwise(F.array(F.lit(None).cast("string"))))

    return F.filter(F.array_distinct(F.flatten(once(bare, named))), lambda e: e.isNotNull() & (F.length(e) > 2))


# Words of a query that are no terms.
QUERY_STOP_WORDS = ["the", "and", "for", "with", "from", "that", "this", "into", "der", "die", "das", "und", "mit", "für", "vom", "von", "dass", "nfl", "american", "football", "headshot", "photo", "image"]


def query_terms(c: Column, most: int = 8) -> Column:
    """the first distinct terms of a query."""
    kept = F.filter(F.split(F.trim(c), r"\s+"), lambda w: ~w.startswith("-") & ~F.contains(w, F.lit("site:")))
    bare = F.transform(kept, lambda w: F.lower(F.regexp_replace(w, "[^a-zA-Z0-9]", "")))
    return F.slice(F.array_distinct(F.filter(bare, lambda w: (F.length(w) >= 3) & ~w.isin(*QUERY_STOP_WORDS))), 1, most)


# The forms of dates in feeds.
DATE_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd HH:mm:ss", "EEE, d MMM yyyy HH:mm:ss Z", "EEE, d MMM yyyy HH:mm:ss zzz", "d MMM yyyy HH:mm:ss Z", "yyyy-MM-dd"]


def feed_date(c: Column) -> Column:
    """a time in UTC from ISO or mail formats; null where none fits."""
    text = F.trim(c)
    mail = F.regexp_replace(text, r"^[A-Za-z]{3},\s*", "")
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS if not f.startswith("EEE")]
    tries += [F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss zzz"))]
    return F.coalesce(*tries)


# Words that are no themes.
THEME_STOP_WORDS = ["the", "and", "for", "with", "that", "from", "this", "game", "team", "season", "have", "will", "their"]


def theme_words(c: Column) -> Column:
    """words of more than three letters, others' characters dropped."""
    bare = F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\s]+", ""), r"\s+")
    return F.filter(bare, lambda w: (F.length(w) > 3) & ~w.isin(*THEME_STOP_WORDS))


# Capitalised words that are no names.
COMMON_WORDS = ["the", "and", "for", "with", "from", "into", "game", "season", "team", "coach", "match", "league"]


def name_runs(c: Column) -> Column:
    """runs of up to four capitalised words; letters of any script bound a word."""
    runs = F.regexp_extract_all(c, F.lit(r"(?<![\p{L}\p{N}_])([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)(?![\p{L}\p{N}_])"), F.lit(1))
    return F.filter(runs, lambda r: ~F.lower(r).isin(*COMMON_WORDS) & (F.size(F.split(r, r"\s+")) <= 4))


def formatted_summary(c: Column, remove: list[str] | None = None) -> Column:
    """without lead-in labels and unwanted patterns, white space collapsed."""
    out = F.regexp_replace(F.regexp_replace(F.trim(c), r"(?i)^summary:\s*", ""), r"(?i)^key points:\s*", "")
    for pattern in remove or []:
        out = F.regexp_replace(out, f"(?i){pattern}", "")
    return squeezed(out)
