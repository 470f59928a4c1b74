"""Word lists and patterns that must equal the specification for equal results."""

LEGAL_SUFFIXES = "corp corporation inc incorporated ltd limited pvt private co company llc plc gmbh sa sasu sarl eurl snc gie bv srl pc llp lp".split()
TOP_LEVEL_DOMAINS = "com org net in fr co io edu gov biz".split()
STOP_WORDS = """
street road avenue drive lane boulevard court place suite floor building unit near opposite behind block north south east west
central main state city town center centre group services solutions international global traders trading enterprise enterprises
india pvt ltd france us
""".split()
DOMAINS = {
    "health": "hospital clinic dental pharmacy chemist medical diagnostics healthcare optical doctor physicians pediatric cardiology".split(),
    "hospitality": "hotel resort inn suites lodge motel hostel residency banquet hospitality".split(),
    "education": "school college academy institute university vidyalaya convent classes tuition".split(),
    "automotive": "auto motors garage tyre tires automobile hero honda maruti bajaj workshop wheels".split(),
    "food": "restaurant cafe bakery sweets dhaba pizza kitchen snacks caterers dining foods".split(),
    "finance": "bank finance investments insurance loan wealth securities".split(),
    "legal": "legal advocate attorney law".split(),
}
CONNECTIVES = "of and the for in to on at de des du".split()
SIX_DIGIT_COUNTRIES = ("in", "india")
FIVE_DIGIT_COUNTRIES = ("us", "usa", "united states", "fr", "france")

URL_PATTERN = r"\b(https?://|www\.)?\S+\.(" + "|".join(TOP_LEVEL_DOMAINS) + r")\b"
LEGAL_PATTERN = r"\b(" + "|".join(LEGAL_SUFFIXES) + r")\b"
NUMBER_PATTERN = r"\b\d+\b"
SIX_DIGITS = r"\b([1-9]\d{5})\b"
FIVE_DIGITS = r"\b(\d{5})(?:-\d{4})?\b"
FIRST_HOUSE = r"\b\d{1,6}\b"
