"""Fixed values of action-verb annotation, in their natural order.

A line of VERBS: lemma | category | operative surfaces | preambular surfaces | force |
sentiment | bindingness | marks, where marks are ``budget``, ``addressee`` and a carrier
name.  Of two entries for one surface the first counts.
"""

from __future__ import annotations

from dataclasses import dataclass

VERBS = """
note | observing | notes | noting | 0 | 0 | contextual | note
take note | observing | takes note | taking note | 0 | 0 | contextual | take_note
take into account | observing | takes into account | taking into account, taking into consideration, taking account | 0 | 0 | contextual |
observe | observing | observes | observing | 0 | 0 | contextual |
recognize | observing | recognizes, recognises | recognizing, recognising | 0 | 0 | contextual |
acknowledge | observing | acknowledges | acknowledging | 0 | 0 | contextual |
consider | observing | considers | considering | 0 | 0 | contextual |
realize | observing | realizes, realises | realizing, realising | 0 | 0 | contextual |
bear in mind | observing | bears in mind | bearing in mind | 0 | 0 | contextual |
consider | observing | | having considered, having examined, having heard, having received, having reviewed, having noted, having adopted, having studied | 0 | 0 | contextual |
confirm | observing | confirms | confirming | 0 | 0 | contextual |
be aware | observing | | aware, fully aware | 0 | 0 | contextual |
be conscious | observing | | conscious, fully conscious | 0 | 0 | contextual |
be mindful | observing | | mindful | 0 | 0 | contextual |
be cognizant | observing | | cognizant | 0 | 0 | contextual |
be convinced | observing | | convinced, fully convinced | 0 | 0 | contextual |
believe | observing | believes | believing | 0 | 0 | contextual |
guided by | observing | | guided | 0 | 0 | contextual |
desirous | observing | | desirous | 0 | 0 | contextual |
reaffirm | reinforcing | reaffirms | reaffirming | 0 | 0 | contextual |
recall | reinforcing | recalls | recalling | 0 | 0 | contextual |
reiterate | reinforcing | reiterates | reiterating | 0 | 0 | contextual |
reconfirm | reinforcing | reconfirms | reconfirming | 0 | 0 | contextual |
affirm | reinforcing | affirms | affirming | 0 | 0 | contextual |
underline | reinforcing | underlines | underlining | 0 | 0 | contextual |
underscore | reinforcing | underscores | underscoring | 0 | 0 | contextual |
emphasize | reinforcing | emphasizes, emphasises | emphasizing, emphasising | 0 | 0 | contextual |
stress | reinforcing | stresses | stressing | 0 | 0 | contextual |
highlight | reinforcing | highlights | highlighting | 0 | 0 | contextual |
remain | reinforcing | remains | remaining | 0 | 0 | contextual |
welcome | evaluative | welcomes | welcoming | 0 | 1 | contextual |
commend | evaluative | commends | commending | 0 | 1 | contextual |
appreciate | evaluative | appreciates | appreciating | 0 | 1 | contextual |
support | evaluative | supports | supporting | 1 | 1 | contextual |
look forward | evaluative | looks forward, look forward | looking forward | 0 | 1 | contextual |
congratulate | evaluative | congratulates | congratulating | 0 | 1 | contextual |
thank | evaluative | thanks | thanking | 0 | 1 | contextual |
be concerned | evaluative | are concerned, is concerned, are deeply concerned, are gravely concerned, are seriously concerned, remains concerned, remains deeply concerned, remain concerned, remain deeply concerned | concerned, gravely concerned, deeply concerned, seriously concerned, deeply troubled, troubled, remaining concerned, remaining deeply concerned | 0 | -1 | contextual |
be alarmed | evaluative | | alarmed, gravely alarmed, deeply alarmed | 0 | -1 | contextual |
be disturbed | evaluative | | disturbed, deeply disturbed | 0 | -1 | contextual |
regret | evaluative | regrets | regretting | 0 | -1 | contextual |
deplore | evaluative | deplores | deploring | 0 | -1 | contextual |
condemn | evaluative | condemns | condemning | 0 | -1 | contextual |
denounce | evaluative | denounces | denouncing | 0 | -1 | contextual |
reject | evaluative | rejects | rejecting | 0 | -1 | contextual |
deprecate | evaluative | deprecates | deprecating | 0 | -1 | contextual |
trust | evaluative | trusts | trusting | 0 | 1 | contextual |
express | evaluative | expresses | expressing | 0 | 0 | contextual | express
decide | deciding | decides | deciding | 5 | 0 | binding | budget
resolve | deciding | resolves | resolving | 4 | 0 | contextual |
endorse | deciding | endorses | endorsing | 4 | 1 | binding | budget
approve | deciding | approves | approving | 5 | 0 | binding | budget
adopt | deciding | adopts | adopting | 5 | 0 | binding | budget
appropriate | deciding | appropriates | | 5 | 0 | binding | budget
establish | deciding | establishes | establishing | 5 | 0 | binding | budget
authorize | deciding | authorizes, authorises | authorizing, authorising | 5 | 0 | binding | budget addressee
determine | deciding | determines | | 5 | 0 | binding |
renew | deciding | renews | renewing | 5 | 0 | binding | budget
proclaim | deciding | proclaims | proclaiming | 4 | 0 | contextual |
declare | deciding | declares | declaring | 4 | 0 | contextual |
agree | deciding | agrees | agreeing | 4 | 0 | contextual |
commit | deciding | commits, are determined, is determined, commit ourselves, commits itself, undertakes | committing | 3 | 1 | contextual |
recommit | deciding | recommits, rededicate ourselves, recommit ourselves | | 3 | 1 | contextual |
pledge | deciding | pledges | pledging | 3 | 1 | contextual |
continue | deciding | continues | continuing | 4 | 0 | contextual |
accept | deciding | accepts | accepting | 3 | 0 | contextual |
request | directive | requests | requesting | 3 | 0 | hortatory | budget addressee
call upon | directive | calls upon | calling upon | 3 | 0 | hortatory | addressee
call on | directive | calls on | calling on | 3 | 0 | hortatory | addressee
call for | directive | calls for | calling for | 3 | 0 | hortatory |
urge | directive | urges | urging | 4 | 0 | hortatory | addressee
encourage | directive | encourages | encouraging | 1 | 1 | hortatory | addressee
invite | directive | invites | inviting | 1 | 0 | hortatory | addressee
demand | directive | demands | demanding | 5 | 0 | hortatory | addressee
recommend | directive | recommends | recommending | 2 | 0 | hortatory | addressee
appeal | directive | appeals | appealing | 2 | 0 | hortatory | addressee
remind | directive | reminds | reminding | 2 | 0 | hortatory | addressee
direct | directive | directs | directing | 4 | 0 | binding | budget addressee
suggest | directive | suggests | suggesting | 1 | 0 | hortatory |
discourage | directive | discourages | discouraging | 1 | -1 | hortatory | addressee
ask | directive | asks | asking | 3 | 0 | hortatory | addressee
"""

# Words that may stand before the verb, by kind.
MODIFIERS: dict[str, tuple[str, ...]] = {
    "repetition": ("also", "further", "once again", "again"),
    "intensity": (
        "strongly", "deeply", "gravely", "seriously", "firmly", "fully", "solemnly", "vehemently", "resolutely",
        "categorically", "unequivocally", "urgently", "particularly", "especially", "profoundly", "sincerely", "warmly",
        "strenuously", "unreservedly", "wholeheartedly",
    ),
    "connective": (
        "in this regard", "in this context", "in that regard", "therefore", "accordingly", "moreover", "furthermore",
        "similarly", "likewise", "nevertheless", "hereby", "consequently", "to that end", "to this end", "in particular",
    ),
}

# Nouns that give a carrier verb its polarity, and words passed over before them.
POSITIVE = ("appreciation", "satisfaction", "gratitude", "support", "confidence", "hope", "readiness", "willingness", "commitment", "conviction")
NEGATIVE = ("concern", "grave concern", "deep concern", "serious concern", "alarm", "regret", "disappointment", "dismay", "indignation",
            "outrage", "anguish", "sadness", "worry", "apprehension")
FILLERS = ("its", "the", "his", "her", "their", "our", "a", "deep", "grave", "serious", "profound", "great", "strong", "full", "sincere",
           "utmost", "continued", "renewed")

# Addressee classes in order of precedence, by words anywhere in the text.
ADDRESSEES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("secretary-general", ("secretary-general", "secretary general")),
    ("special_procedure", (
        "special rapporteur", "special representative", "special adviser", "special envoy", "working group", "independent expert",
        "mandate holder", "commission of inquiry", "fact-finding", "panel of experts", "monitoring group", "group of experts",
        "high commissioner",
    )),
    ("secretariat_entity", (
        "secretariat", "executive director", "executive secretary", "under-secretary-general", "office for", "office of", "office on",
        "department of", "ohchr", "unodc", "unctad", "un-women", "un women", "unep", "un-habitat", "unhcr", "undp", "unicef", "unfpa",
        "unrwa", "director-general", "director general", "focal point",
    )),
    ("member_states", (
        "member states", "all states", "states members", "the states", "governments", "government of", "all governments",
        "states parties", "member and observer states", "nation states", "administering powers",
    )),
    ("un_system", (
        "united nations system", "united nations development system", "un system", "development system", "funds and programmes",
        "specialized agencies", "specialised agencies", "un agencies", "united nations agencies", "un funds", "un programmes",
        "organizations of the united nations", "entities of the united nations", "united nations entities", "united nations bodies",
        "relevant organizations", "resident coordinator",
    )),
    ("un_body", (
        "general assembly", "security council", "economic and social council", "ecosoc", "human rights council",
        "president of the general assembly", "committee", "commission", "conference", "the council", "the assembly",
        "regional commissions", "subsidiary bod", "the board", "the bureau", "cstd", "cpc", "advisory committee", "the panel", "the group",
        "peacebuilding commission", "the forum", "the platform",
    )),
    ("ngo_other", (
        "civil society", "non-governmental organization", "non-governmental organisation", "ngo", "private sector",
        "international community", "international organization", "international organisation", "regional organization",
        "regional organisation", "financial institution", "stakeholder", "partner", "academia", "donor", "business", "parliament",
        "media", "youth", "women", "children", "indigenous", "employers", "trade union", "philanthrop",
    )),
)
QUANTIFIERS = ("all relevant", "all other", "all the", "the relevant", "relevant", "all", "the", "other", "those", "these", "both", "each",
               "every", "concerned", "appropriate")

# Verbs that govern the items below a clause that ends in a colon.
GOVERNING = {"decide": "decide", "resolve": "resolve", "commit": "commit", "agree": "agree", "pledge": "pledge", "undertake": "commit"}
GOVERNS = r"(?i)\b(decide|resolve|commit|agree|pledge|undertake)s?\b[^:]{0,45}\bto:\s*$"
GOVERNED = r"(?i)\b(?:are|is|have been|has been)\s+(encouraged|invited|urged|requested|reminded|called upon)\b"
CHAPTER_SEVEN = r"(?i)^acting\b.{0,40}\bchapter\s+vii"
PASSIVE = {"encouraged": "encourage", "invited": "invite", "urged": "urge", "requested": "request", "reminded": "remind", "called upon": "call upon"}


@dataclass(frozen=True)
class Verb:
    lemma: str
    category: str
    operative: tuple[str, ...]
    preambular: tuple[str, ...]
    force: int
    sentiment: int
    bindingness: str
    budget: bool
    addressee: bool
    carrier: str | None


def verbs() -> list[Verb]:
    out = []
    for line in VERBS.strip().splitlines():
        lemma, category, op, pre, force, sentiment, binding, marks = (p.strip() for p in line.split("|"))
        names = lambda s: tuple(x.strip() for x in s.split(",") if x.strip())
        flags = marks.split()
        carrier = next((f for f in flags if f not in ("budget", "addressee")), None)
        out.append(Verb(lemma, category, names(op), names(pre), int(force), int(sentiment), binding, "budget" in flags, "addressee" in flags, carrier))
    return out


# Verbs whose bare form may head an item below a clause.
IMPERATIVES = (
    "request", "call upon", "call on", "call for", "urge", "encourage", "invite", "demand", "recommend", "remind", "direct", "appeal", "recognize",
    "acknowledge", "reaffirm", "recall", "reiterate", "affirm", "decide", "resolve", "commit", "endorse", "adopt", "approve", "establish", "note",
    "take note", "welcome", "condemn", "deplore", "stress", "emphasize", "underline", "underscore", "highlight", "commend", "consider", "determine",
    "authorize", "proclaim",
)


def surfaces(bare: bool = False) -> dict[str, tuple[Verb, str]]:
    """Surface -> (verb, form), the first entry of each; with ``bare`` the imperatives as well."""
    out: dict[str, tuple[Verb, str]] = {}
    for v in verbs():
        for form, names in (("operative", v.operative), ("preambular", v.preambular)):
            for s in names:
                out.setdefault(s, (v, form))
        if bare and v.lemma in IMPERATIVES:
            out.setdefault(v.lemma, (v, "operative"))
    return out
