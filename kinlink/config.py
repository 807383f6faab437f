"""Settings, and the fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---- Fixed values: word lists, tables, patterns and parameters that must stand as they are for the results to be right.

LEGAL_SUFFIXES = {
    "inc": "inc",
    "incorporated": "inc",
    "corp": "corp",
    "corporation": "corp",
    "co": "co",
    "company": "co",
    "ltd": "ltd",
    "limited": "ltd",
    "llc": "llc",
    "llp": "llp",
    "lp": "lp",
    "plc": "plc",
    "pc": "pc",
    "pvt ltd": "pvt ltd",
    "private limited": "pvt ltd",
    "pvt limited": "pvt ltd",
    "private ltd": "pvt ltd",
    "pvt": "pvt",
    "private": "pvt",
    "sarl": "sarl",
    "sas": "sas",
    "sasu": "sasu",
    "eurl": "eurl",
    "sa": "sa",
    "sci": "sci",
    "snc": "snc",
    "gie": "gie",
}
ADDRESS_WORDS = {
    "rd": "road",
    "ave": "avenue",
    "av": "avenue",
    "blvd": "boulevard",
    "bd": "boulevard",
    "dr": "drive",
    "ln": "lane",
    "cir": "circle",
    "ct": "court",
    "pl": "place",
    "sq": "square",
    "ste": "suite",
    "apt": "apartment",
    "fl": "floor",
    "bldg": "building",
    "dept": "department",
    "pkwy": "parkway",
    "hwy": "highway",
    "expwy": "expressway",
    "opp": "opposite",
    "nr": "near",
    "mkt": "market",
    "ngr": "nagar",
    "clny": "colony",
    "sec": "sector",
    "soc": "society",
    "apts": "apartments",
    "comp": "complex",
    "cplx": "complex",
    "ind": "industrial",
    "est": "estate",
    "r": "rue",
    "rte": "route",
    "imp": "impasse",
    "all": "allee",
    "chem": "chemin",
    "qu": "quai",
    "pass": "passage",
}
STOPWORDS = (
    "and the of in for at to by on with co company inc corp corporation ltd limited pvt private llc llp services service group "
    "solutions enterprises enterprise center centre industries international holding holdings management associates consulting "
    "technologies technology systems india us usa france sarl sas sasu eurl sci"
).split()
COUNTRIES = {
    "US": ["us", "usa", "united states", "united states of america"],
    "India": ["india", "ind", "bharat"],
    "France": ["france", "fra", "fr"],
}
ACRONYM_DOT = r"(?<=\b[a-zA-Z])\.(?=[a-zA-Z]\b|[^\w]|$)"
POSTAL_INDIA = r"\b([1-9]\d{5})\b"
POSTAL_US = r"\b(\d{5}(?:-\d{4})?)\b"
POSTAL_FRANCE = r"\b((?:0[1-9]|[1-8]\d|9[0-8])\d{3})\b"
HOUSE_PREFIXED = (
    r"(?i)\b(?:door\s*no\.?|shop\s*no\.?|plot\s*no\.?|h\.?\s*no\.?|no\.?|unit|#)\s*"
    r"([a-zA-Z0-9\-/\s]+?)(?:,|$|\s+(?:rue|street|road|ave|avenue|blvd|lane|st|rd|dr))"
)
HOUSE_LEADING = r"(?i)^\s*\(?\s*([a-zA-Z]?-?\d+[a-zA-Z]?(?:[\-\s/]+\d+[a-zA-Z]?)?(?:\s+bis|\s+ter)?)\s*\)?\b"
HOUSE_BEFORE_STREET = (
    r"(?i)\b(\d+(?:[\-\s]+\d+)?(?:\s+bis|\s+ter)?)\s*,?\s*"
    r"(?:rue|bd|boulevard|ave|avenue|road|rd|street|st|lane|ln|drive|dr|circle|cir|all[eé]e|impasse)\b"
)
PAIR_FEATURES = (
    "name_lev name_partial name_token_sort name_token_set name_core_sort name_jaccard name_3gram_jaccard name_4gram_jaccard "
    "prefix_3_match prefix_5_match first_token_match suffix_match name_len_diff name_len_ratio addr_lev addr_token_sort "
    "addr_token_set addr_jaccard postal_match house_match numeric_jaccard s1_addr_empty cand_addr_empty both_addr_empty "
    "addr_len_ratio full_token_set is_s2 is_s3 country_is_us country_is_in country_is_fr"
).split()
GROUP_FEATURES = ["candidate_rank", "name_sort_diff_to_best", "total_candidates_for_s1"]
#: Thresholds of the sweep: 0.35 to 0.89 in steps of 0.02.
THRESHOLDS = [round(0.35 + 0.02 * i, 2) for i in range(28)]
#: Rules in the order in which they fire.
RULES = ["exact_core_name", "exact_full_name", "token_signature", "rare_token", "postal_code_block", "house_number_block", "char_tfidf", "combined_tfidf"]

# ---- end of the fixed values


@dataclass(frozen=True)
class NormalizationConfig:
    expand_street: bool = False
    legal_suffixes: dict[str, str] = field(default_factory=lambda: dict(LEGAL_SUFFIXES))
    address_words: dict[str, str] = field(default_factory=lambda: dict(ADDRESS_WORDS))


@dataclass(frozen=True)
class BlockingConfig:
    """Candidate channels and their caps."""

    exact_core: bool = True
    exact_full: bool = True
    signature: bool = True
    rare_token: bool = True
    postal: bool = True
    house: bool = True
    token_min_length: int = 3
    token_min_df: int = 1
    token_max_df: int = 500
    token_cap: int = 10
    postal_max_df: int = 500
    postal_cap: int = 15
    house_max_df: int = 500
    house_cap: int = 15
    char_tfidf: bool = False
    char_k: int = 5
    char_floor: float = 0.5
    combined_tfidf: bool = False
    combined_k: int = 3
    combined_floor: float = 0.4
    weak_name_gate: bool = True
    total_cap: int | None = 30


DEFAULT = BlockingConfig()
CONFIG_A = replace(DEFAULT, total_cap=50)
CONFIG_B = replace(CONFIG_A, char_tfidf=True, combined_tfidf=True)
CONFIG_C = replace(CONFIG_B, token_max_df=400, token_cap=8, postal_max_df=300, postal_cap=10, house_max_df=300, house_cap=10, char_k=4, char_floor=0.55, combined_k=2, combined_floor=0.45, total_cap=30)
CONFIG_INFERENCE = replace(DEFAULT, token_max_df=1000, token_cap=15, postal_max_df=1000, postal_cap=20, house_max_df=1000, house_cap=20, total_cap=25)
CONFIG_TRAINING = CONFIG_B
