"""The layouts that documents and search hits are read by, as Java patterns."""

FACTION = r"CDU|SPD|GRÜNE|FDP|AfD|fraktionslos"
ASKED_BY = r"(?:des\s+Abgeordneten|der\s+Abgeordneten)"
WORDED = r"\d{1,2}\.\s*[A-Za-zÄÖÜäöüß]+\s+\d{4}"
DIGITS = r"\d{1,2}\.\d{1,2}\.\d{4}"

# First page of an answer
ANSWER_PAPER = r"(?U)Drucksache\s+(\d+/\d+)"
QUESTION_NUMBER = rf"(?U)Kleine Anfrage\s+(\d+)(?![\d/])(?:\s+vom\s+({WORDED}))?"
ASKER = rf"(?U){ASKED_BY}\s+(.+?)\s+({FACTION})\b"
QUESTION_PAPER = rf"(?sU){ASKED_BY}\s+.{{1,400}}?\s+(?:{FACTION})\s*\n\s*Drucksache\s+(\d+/\d+)"
ISSUED = rf"(?U)Ausgegeben:\s*({DIGITS})"
TITLE = rf"(?sU){ASKED_BY}\s+.{{1,200}}?\s+(?:{FACTION})\s*\n+\s*Drucksache\s+\d+/\d+[ \t]*\n+(.{{1,400}}?)\n[ \t]*\n+\s*Vor(?:be)?merkung\s+der\s+Kleinen\s+Anfrage"
MINISTRY = r"(?sU)(?:(?:Der|Die)\s+)?(Minister(?:präsident(?:in)?|in)?)(?:\s+(?:der|des|für|für\s+die))?(?:\s+([^.]{1,200}?))?\s+hat\s+die\s+Kleine\s+Anfrage"
ANSWER = r"(?U)(Vor(?:be)?merkung\s+der\s+Kleinen\s+Anfrage|hat\s+die\s+Kleine\s+Anfrage)"
LARGE_INQUIRY = r"(?U)Antwort\s+der\s+Landesregierung\s+auf\s+die\s+Große\s+Anfrage"

# Header of an answer, tolerant of lost spaces
LETTER_DATE = rf"(?U)mit\s+Schreiben\s+vom\s+({WORDED}|{DIGITS})"
ASKED_ON = rf"(?U)Kleine\s+Anfrage\s+\d+\s*vom\s+({WORDED}|{DIGITS})"
FACTION_AND_PAPER = r"(?U)(BÜNDNIS\s*90\s*[/ ]\s*DIE\s*GRÜNEN|FRAKTIONSLOS|fraktionslos|AfD|AFD|SPD|CDU|FDP|DIE\s*LINKE)\s*\n?\s*Drucksache\s*(\d+/\d+)"
DOUBLED_HEADER = r"LL?AA?NN?DD?TT?AA?GG?"

# The sentence that names the answering ministers, and each of them
BOUNDARY = r"(?U)((?:Der|Die|Das)\s+Minister(?:präsident(?:in)?|in|ium|ien)?\b.{0,800}?\bdie\s+Kleine\s+Anfrage\s+\d+.{0,400}?\bbeantwortet\b[^.]{0,30}\.)"
NEXT_MINISTER = r"(?:[A-ZÄÖÜ][a-zäöüß]+)?[Mm]inister[a-zäöüß]*\b"
STOPS = [
    r"\s+hat\b", r"\s+haben\b", r"\s+im\s+Einvernehmen\b", r"\s+in\s+Abstimmung\b", r"\s+gemeinsam\s+mit\b", r"\s+nach\s+Beteiligung\b",
    r"\s+unter\s+Mitwirkung\b", r"\s+beantwortet\b", r"\s+beantworten\b", r"\s+wie\s+folgt\b", r"\s+namens\s+der\s+Landesregierung\b",
    r"\s+des\s+Landes\s+Nordrhein-Westfalen\b", rf"\s+und\s+(?:mit\s+)?(?:dem|der|des|den)\s+{NEXT_MINISTER}",
    rf"\s+sowie\s+(?:mit\s+)?(?:dem|der|des|den)?\s*{NEXT_MINISTER}", rf"\s*,\s+(?:mit\s+)?(?:dem|der|des|den)\s+{NEXT_MINISTER}",
]
MINISTER = rf"(?U)\b(?:Der|Die|Das|der|die|das|dem|des|den)\s+(Minister(?:präsident(?:in)?|in|ium|ien)?)\s+(für|der|des)\s+(.+?)(?={'|'.join(STOPS)})"

# Blocks of askers
BLOCK_END = r"BÜNDNIS\s*90\s*/\s*DIE\s*GRÜNEN?|CDU|SPD|GRÜNEN?|FDP|AfD"
ASKER_BLOCK = rf"(?sU)(?:des|der)\s+Abgeordneten(?:\s+|(?=[A-ZÄÖÜ]))(.{{1,1000}}?)\s*(?:{BLOCK_END}|fraktionslos)\b"
BLOCK_AND_MORE = rf"{ASKER_BLOCK}(?:\s*\bund\s+(.{{1,200}}?)\s*(?:{BLOCK_END}|[Ff]raktionslos|FRAKTIONSLOS)\b)?"

# Foot of a first page
LETTER_FOOT = r"(?U)Datum\s+des\s+Originals\s*:\s*(\d{1,2}[. ]\d{1,2}[. ]\d{2,4})(?:\s*[/;]\s*Ausgegeben\s*:\s*(\d{1,2}[. ]\d{1,2}[. ]\d{2,4}))?"

# Search hits, as lines of text
HIT_NUMBER = r"(?mdU)^Kleine Anfrage\s+(\d+)(?![\d/])(?:\s+zu\s+Drs\s+\d+/\d+)?\s*$"
HIT_ASKER = rf"(?mdU)^\n*([^\n]+?)\s+({FACTION})\s*$"
HIT_DATE = rf"(?U)({DIGITS})\s+\d+\s*S\."
HIT_MINISTRY = r"(?mdU)^Antwort\s+([A-ZÄÖÜ]{2,10})\s*\n\s*Drucksache\s+\d+/\d+"
HIT_WITHDRAWN = r"(?U)\bUnterrichtung\s+Präs\b"
HIT_TOPICS = r"(?sdU)Systematik:\s*\n(.+?)(?:\nSchlagworte:|\nRegion:|\nAntwort\s|$)"
HIT_KEYWORDS = r"(?sdU)Schlagworte:\s*\n(.+?)(?:\nRegion:|\nSystematik:|\nAntwort\s|$)"
HIT_LINK = r"<a[^>]*href=\"([^\"]*MMD(\d+)-(\d+)\.pdf[^\"]*)\""
SITE = "https://www.landtag.nrw.de"
# Where a paper's document lies: the folder, and what an address that may be fetched looks like
DOCUMENTS = SITE + "/portal/WWW/dokumentenarchiv/Dokument/"
DOCUMENT_URL = r"^https://www\.landtag\.nrw\.de/portal/WWW/dokumentenarchiv/Dokument/MMD\d+-\d+\.pdf$"

# Log lines
NOVELTY_LINE = r'^\S+\s\|\s(\S+)\s\|\sministerium_form\s\|\sscraped="(.+)"$'
MISMATCH_LINE = r'\| (\S+) \| (\S+) \| MISMATCH parsed=(\d+) db_min=(\d+) \| db_anfrager="([^"]*)" \| block="([^"]*)"'

# Words that lines have cut: patterns and what they become, in order
HYPHENATION = [
    (r"(?U)(\w)-([a-zäöüß])", "$1$2"),
    (r"(?U)(\w)-\s+(?!(?:und|oder|sowie|noch)\b)([a-zäöüß])", "$1$2"),
    (r"(?U)\bBundesund\b", "Bundes und"),
    (r"(?U)([a-zäöüß])namens\b", "$1 namens"),
]
# Endings that a ministry's word loses
MINISTRY_SUFFIX = r"^(.+?)(ministeriums|ministerium|ministerinnen|ministerin|ministers|minister)$"
