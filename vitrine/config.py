"""Rule parameters of the operators.

FIXED VALUES: the keyword lists, thresholds and labels below must equal the
behaviour being reproduced for results to match. They are stated plainly, in
their natural order, and passed to the operators as parameters; operators never
hard-code them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES -- heuristic labelling (TXT10)
# ---------------------------------------------------------------------------
OFFICIAL_STORES = ["hp oficial", "loja oficial hp", "hp store", "hp do brasil"]
ORIGINAL_KEYWORDS = ["original", "genuíno", "autêntico", "direto da fábrica",
                     "com nota fiscal", "lacrado"]
SUSPICIOUS_KEYWORDS = ["compatível", "similar", "genérico", "remanufaturado",
                       "alternativo", "paralelo", "recarga"]
COMMON_TYPOS = ["cartucho hp", "cartucho h p", "cartucho h.p."]
TYPO_EXCLUDE = "cartucho hp"
GENERIC_SELLERS = ["eletrônicos xyz", "distribuidora abc", "loja online"]
LOW_PRICE = 30.0
HIGH_PRICE = 200.0
LOW_RATING = 3.0
MANY_REVIEWS = 50
W_OFFICIAL = 0.4
W_ORIGINAL_KW = 0.3
W_SUSPICIOUS_KW = 0.4
W_LOW_PRICE = 0.3
W_HIGH_PRICE = 0.1
W_LOW_RATING = 0.2
W_TYPO = 0.1
W_GENERIC_SELLER = 0.1
LABEL_ORIGINAL = "original"
LABEL_SUSPICIOUS = "pirate/suspicious"
LABEL_MIXED = "mixed_signals"
LABEL_UNKNOWN = "unknown"
MIXED_CONFIDENCE = 0.5

# ---------------------------------------------------------------------------
# FIXED VALUES -- enrichment (TXT6, TXT7, TXT8)
# ---------------------------------------------------------------------------
CLASS_ORIGINAL = "Original"
CLASS_COMPATIBLE = "Compatível"
CLASS_SUSPECT = "Suspeito"
CLASS_UNCLASSIFIED = "Não Classificado"
CLASS_ORIGINAL_WORD = "original"
CLASS_COMPATIBLE_WORD = "compativel"
CLASS_SUSPECT_WORDS = ["recarregado", "generico", "similar"]
MODEL_PATTERN = r"modelo:?\s*([a-z0-9\-]+)"
COLOR_PATTERN = r"cor:?\s*(preto|colorido|tricolor|magenta|ciano|amarelo)"
YIELD_PATTERN = r"rendimento:?\s*(\d+)\s*paginas"
SEALED_WORDS = ["lacrado"]
INVOICE_WORDS = ["nota fiscal", "nf-e"]
WARRANTY_WORDS = ["garantia"]

# ---------------------------------------------------------------------------
# FIXED VALUES -- listing cleaning and validation (CLN7, CLN8, FIL1)
# ---------------------------------------------------------------------------
PRODUCT_TYPES = ["cartucho", "toner", "tinta"]
PRODUCT_TYPE_OTHER = "outros"
HP_KEYWORDS = ["hp", "hewlett", "packard"]
TITLE_MAX = 500
DESCRIPTION_MAX = 2000
SELLER_MAX = 200
DEFAULT_PLATFORM = "mercadolivre"
TEXT_MAX = 10000

# ---------------------------------------------------------------------------
# FIXED VALUES -- text features (TXT2): keyword groups in their order
# ---------------------------------------------------------------------------
KEYWORD_GROUPS = [
    ("original", ["original", "genuine", "authentic", "official"]),
    ("hp_brand", ["hp", "hewlett", "packard"]),
    ("quality", ["quality", "premium", "professional", "high-quality"]),
    ("compatibility", ["compatible", "compatível", "replacement"]),
    ("warranty", ["warranty", "garantia", "guarantee"]),
    ("sealed", ["sealed", "lacrado", "new", "novo"]),
    ("invoice", ["invoice", "nota fiscal", "receipt", "nf"]),
]

# ---------------------------------------------------------------------------
# FIXED VALUES -- confidence bands (INT11)
# ---------------------------------------------------------------------------
CONFIDENCE_BANDS = [(0.9, "Very High"), (0.8, "High"), (0.7, "Moderate"), (0.6, "Low")]
CONFIDENCE_BAND_ELSE = "Very Low"

# ---------------------------------------------------------------------------
# FIXED VALUES -- the 14-column raw listing order (SRC4) and the 12 shared
# columns of the source union (SET1) and the structured set (CLN13)
# ---------------------------------------------------------------------------
RAW_COLUMN_ORDER = ["title", "price", "seller_name", "seller_reputation", "reviews_count",
                    "rating", "url", "platform", "description", "specifications", "images",
                    "availability", "shipping_info", "scraped_at"]
SHARED_COLUMNS = ["title", "price", "seller_name", "reviews_count", "rating", "description",
                  "specifications", "images", "availability", "shipping_info", "url", "platform"]
STRUCTURED_FEATURES = ["title", "description", "seller_name", "platform", "price_numeric",
                       "rating_numeric", "reviews_count", "is_original", "is_xl", "product_type",
                       "has_sealed_info", "has_invoice_info", "has_warranty_info"]
CLEAN_TEXT_COLUMNS = ["title", "description", "specifications", "seller_name",
                      "seller_reputation", "shipping_info"]


@dataclass(frozen=True)
class LabelRules:
    """Parameters of the heuristic labeller; defaults are the fixed values."""
    official_stores: list = field(default_factory=lambda: list(OFFICIAL_STORES))
    original_keywords: list = field(default_factory=lambda: list(ORIGINAL_KEYWORDS))
    suspicious_keywords: list = field(default_factory=lambda: list(SUSPICIOUS_KEYWORDS))
    typos: list = field(default_factory=lambda: list(COMMON_TYPOS))
    typo_exclude: str = TYPO_EXCLUDE
    generic_sellers: list = field(default_factory=lambda: list(GENERIC_SELLERS))
    low_price: float = LOW_PRICE
    high_price: float = HIGH_PRICE
    low_rating: float = LOW_RATING
    many_reviews: int = MANY_REVIEWS

# ---------------------------------------------------------------------------
# FIXED VALUES -- record validation (CLN9, CLN10, CLN11, CLN12)
# ---------------------------------------------------------------------------
EXPECTED_COLUMNS = ["title", "description", "price_numeric", "rating_numeric",
                    "reviews_count", "platform", "product_type", "seller_name"]
DEFAULT_VALUES = {"title": "", "description": "", "price_numeric": 0.0, "rating_numeric": 0.0,
                  "reviews_count": 0, "platform": "unknown", "product_type": "unknown",
                  "seller_name": "unknown"}
STRING_FIELDS = ["title", "description", "platform", "product_type", "seller_name"]
FLOAT_FIELDS = ["price_numeric", "rating_numeric"]
INT_FIELDS = ["reviews_count"]
REJECT_TITLE_MISSING = "Missing required fields: title"
REJECT_PRICE = "Price must be a valid number"
REJECT_RATING_RANGE = "Rating must be between 0 and 5"
REJECT_RATING = "Rating must be a valid number"
REJECT_REVIEWS_NEGATIVE = "Reviews count must be non-negative"
REJECT_REVIEWS = "Reviews count must be a valid integer"
REJECT_TITLE_LONG = "Title must be less than 500 characters"
REJECT_DESCRIPTION_LONG = "Description must be less than 2000 characters"
WARN_NEGATIVE_PRICE = "Negative price detected, setting to 0"
WARN_RATING_RANGE = "Rating out of range [0-5], clamping"
WARN_NEGATIVE_REVIEWS = "Negative reviews count, setting to 0"

# ---------------------------------------------------------------------------
# FIXED VALUES -- log event classes (FIL3)
# ---------------------------------------------------------------------------
PERFORMANCE_EVENT_TYPES = ["classification_performance", "api_performance",
                           "scraper_performance", "performance_alert"]

# ---------------------------------------------------------------------------
# FIXED VALUES -- page extraction selector maps (PAGE*). Each entry is an
# ordered list of regular expressions whose group 1 is the selected text.
# ---------------------------------------------------------------------------
SITE_A = {
    "title": [r'(?s)<meta property="og:title" content="([^"]*)"', r"(?s)<h1[^>]*>(.*?)</h1>",
              r"(?s)<title[^>]*>(.*?)</title>", r"(?s)<h2[^>]*>(.*?)</h2>",
              r'(?s)<[a-z0-9]+ class="[^"]*product-title[^"]*"[^>]*>(.*?)</'],
    "price": [r'(?s)<span class="[^"]*price[^"]*"[^>]*>(.*?)</span>', r'(?s)<meta itemprop="price" content="([^"]*)"',
              r'(?s)<div class="[^"]*price[^"]*"[^>]*>(.*?)</div>', r'(?s)<div class="ad"[^>]*>(.*?)</div>',
              r"(?s)<h1[^>]*>(.*?)</h1>", r"(?s)<p[^>]*>(.*?)</p>"],
    "seller": [r'(?s)<div class="[^"]*seller[^"]*"[^>]*>(.*?)</div>', r"(?s)<footer[^>]*>(.*?)</footer>"],
    "reputation": [r'(?s)<div class="[^"]*reputation[^"]*"[^>]*>(.*?)</div>', r'(?s)<div class="ad"[^>]*>(.*?)</div>'],
    "availability": [r'(?s)<[a-z0-9]+ class="[^"]*stock[^"]*"[^>]*>(.*?)</'],
    "shipping": [r'(?s)<[a-z0-9]+ class="[^"]*shipping[^"]*"[^>]*>(.*?)</'],
    "reviews": [r'(?s)<[a-z0-9]+ class="[^"]*review[^"]*"[^>]*>(.*?)</', r"(?s)<footer[^>]*>(.*?)</footer>",
                r'(?s)<div class="ad"[^>]*>(.*?)</div>'],
    "rating": [r'(?s)<[a-z0-9]+ class="[^"]*rating[^"]*"[^>]*>(.*?)</'],
}
SITE_B = dict(SITE_A, title=[r"(?s)<title[^>]*>(.*?)</title>", r"(?s)<h1[^>]*>(.*?)</h1>"])
SELLER_FALLBACK = r"Vendido por\s*([^<\n]+)"
DEFAULT_CURRENCY = "R$"
ITEM_LINK_PATTERN = r"^/"
DESCRIPTION_KEYWORDS = ["hp", "cartucho", "tinta", "toner", "the", "and"]
IMAGE_CDN = "cdn"

# The Snowball Portuguese stop words, as Spark MLlib documents them.
STOP_WORDS_PT = tuple("""
de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu
sua ou quando muito nos já eu também só pelo pela até isso ela entre depois sem mesmo aos seus
quem nas me esse eles você essa num nem suas meu às minha numa pelos elas qual nós lhe deles essas
esses pelas este dele tu te vocês vos lhes meus minhas teu tua teus tuas nosso nossa nossos nossas
dela delas esta estes estas aquele aquela aqueles aquelas isto aquilo estou está estamos estão
estive esteve estivemos estiveram estava estávamos estavam estivera estivéramos esteja estejamos
estejam estivesse estivéssemos estivessem estiver estivermos estiverem hei há havemos hão houve
houvemos houveram houvera houvéramos haja hajamos hajam houvesse houvéssemos houvessem houver
houvermos houverem houverei houverá houveremos houverão houveria houveríamos houveriam sou somos
são era éramos eram fui foi fomos foram fora fôramos seja sejamos sejam fosse fôssemos fossem for
formos forem serei será seremos serão seria seríamos seriam tenho tem temos tém tinha tínhamos
tinham tive teve tivemos tiveram tivera tivéramos tenha tenhamos tenham tivesse tivéssemos
tivessem tiver tivermos tiverem terei terá teremos terão teria teríamos teriam
""".split())

# The Snowball English stop words, as Spark MLlib documents them.
STOP_WORDS_EN = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if
or because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very
s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split())

# ---------------------------------------------------------------------------
# FIXED VALUES -- model recommendation. Traits by words of a model's name, first match in order; DEFAULT_TRAIT where none fits.
# ---------------------------------------------------------------------------
MODEL_TRAITS = {
    "interpretability": [(("logistic", "linear"), 0.9), (("tree", "forest"), 0.7), (("svm", "support"), 0.3),
                         (("neural", "mlp", "deep"), 0.1)],
    "speed": [(("logistic", "linear", "naive"), 0.9), (("tree", "forest"), 0.6), (("svm", "support"), 0.4),
              (("neural", "mlp", "boost"), 0.3)],
    "complexity": [(("logistic", "linear", "naive"), 0.2), (("tree",), 0.4), (("forest", "boost"), 0.7), (("svm", "neural"), 0.8)],
    "memory": [(("logistic", "linear", "naive"), 0.9), (("tree", "svm"), 0.7), (("forest", "boost"), 0.5), (("neural", "mlp"), 0.3)],
}
DEFAULT_TRAIT = 0.5
INTERPRETABLE_MODELS = ("logistic", "linear", "tree", "forest")
FAST_MODELS = ("logistic", "linear", "naive_bayes")
# Metrics of a ranking, equally weighted.
RANKING_METRICS = ("f1_score", "roc_auc", "accuracy", "precision", "recall")
