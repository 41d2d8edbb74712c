"""Constants whose exact content decides the results.

Word lists, patterns, limits, formats and lookup tables are stated here plainly and in order.
Nothing in this module computes anything; callers may pass their own values instead.
"""

SCHEMA_VERSION = "1.0"

RECORD_TYPES = ("STARTUP", "PRODUCT", "RESEARCH_PAPER", "JOB", "NEWS")
ENRICHED_TYPE = "NEWS_ENRICHED"

# Characters removed from both ends of a text when it is stripped (Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Pricing labels and the ordered patterns that infer them.
PRICING_VALUES = ("FREE", "FREEMIUM", "PAID", "ENTERPRISE")
PRICING_PATTERNS = (
    (r"\bfreemium\b", "FREEMIUM"),
    (r"\benterprise\b", "ENTERPRISE"),
    (r"\bfree\b", "FREE"),
    (r"\b(paid|subscription|pricing plan)\b", "PAID"),
)

# Ordered role families; a keyword matches anywhere in the lower-cased title.
ROLE_FAMILIES = (
    (("engineer", "developer", "swe"), "Engineering"),
    (("research", "scientist"), "Research"),
    (("product manager", "pm "), "Product"),
    (("sales", "account executive"), "Sales"),
    (("marketing", "growth"), "Marketing"),
    (("design",), "Design"),
    (("recruit", "people", "hr "), "People"),
    (("legal", "counsel"), "Legal"),
    (("finance", "accounting"), "Finance"),
)

REMOTE_PATTERN = r"\bremote\b"

# Topic patterns for news relevance, matched case-insensitively.
TOPIC_PATTERNS = (
    r"\bai\b", r"artificial intelligence", r"machine learning", r"\bllm\b", r"\bllms\b",
    r"large language model", r"neural network", r"generative ai", r"\bgenai\b",
    r"chatbot", r"\bgpt\b", r"openai", r"anthropic", r"\bclaude\b", r"\bgemini\b",
    r"deepmind", r"\bagi\b", r"machine\-learning", r"\bml model", r"foundation model",
    r"\bslm\b", r"transformer model", r"diffusion model",
)

# Name normalisation.
DOMAIN_SUFFIX = r"\.(com|ai|io|dev|art|co)\b"
LEGAL_SUFFIX = r"\b(inc|incorporated|llc|ltd|limited|corp|corporation|co|company|pbc|plc)\b\.?"
NAME_PUNCTUATION = r"[.,\-_/&]"

# Name matching limits.
FUZZY_CUTOFF = 90
FUZZY_MIN_LENGTH = 4
FUZZY_MAX_LENGTH_RATIO = 1.6
METHODS = ("exact_alias", "exact_canonical", "fuzzy", "no_match")

# Dates.
FRESHNESS_HOURS = 24
NOW_PHRASES = ("just now", "now", "moments ago")
RELATIVE_PATTERN = r"(\d+)\s*(second|minute|hour|day|week|month)s?\s*ago"
UNIT_SECONDS = {
    "second": 1,
    "minute": 60,
    "hour": 3600,
    "day": 86400,
    "week": 604800,
    "month": 2592000,
}

# URLs.
COMPANY_PROFILE_BASE = "https://www.ycombinator.com/companies"
REPO_URL_PATTERN = r"https?://github\.com/[\w\-]+/[\w\-.]+"
OWNER_REPO_PATTERN = r"github\.com/([\w\-]+)/([\w\-.]+)"

# Source labels and feeds.
STARTUP_SOURCE = "Y Combinator"
PRODUCT_SOURCE = "Product Hunt"
PAPER_SOURCE = "Arxiv"
FEEDS = {
    "TechCrunch AI": "https://techcrunch.com/category/artificial-intelligence/feed/",
    "VentureBeat AI": "https://venturebeat.com/category/ai/feed/",
    "The Verge AI": "https://www.theverge.com/rss/ai-artificial-intelligence/index.xml",
    "MIT Technology Review AI": "https://www.technologyreview.com/topic/artificial-intelligence/feed",
    "Ars Technica AI": "https://arstechnica.com/tag/ai/feed/",
}

# Ordered job boards per company.
BOARD_CANDIDATES = {
    "OpenAI": [("ashby", "openai"), ("greenhouse", "openai")],
    "ElevenLabs": [("ashby", "elevenlabs"), ("greenhouse", "elevenlabs"), ("lever", "elevenlabs")],
    "Anthropic": [("greenhouse", "anthropic")],
    "Scale AI": [
        ("greenhouse", "scaleai"), ("lever", "scaleai"),
        ("greenhouse", "scale-ai"), ("lever", "scale-ai"),
    ],
    "Cohere": [("lever", "cohere"), ("greenhouse", "cohere"), ("ashby", "cohere")],
}

# Text extraction.
CHAR_BUDGET = 6000
FENCE_PATTERN = r"^```(?:json)?\s*|\s*```$"
PROVIDERS = ("gemini", "groq", "deepseek")
ANSWER_PATHS = {
    "gemini": "$.candidates[0].content.parts[0].text",
    "groq": "$.choices[0].message.content",
    "deepseek": "$.choices[0].message.content",
}
PROMPT_HEAD = "Extract structured data from the following text according to this schema:\n"
PROMPT_TEXT_MARK = "\n\nText:\n"
PRICING_SCHEMA = """{
  "pricingModel": "one of exactly: FREE, FREEMIUM, PAID, ENTERPRISE — or null if genuinely unclear from the text. Do not guess if there is no real signal."
}"""
NEWS_SCHEMA = """{
  "summary": "string, 1-2 sentence neutral summary of the article",
  "key_entities": ["array of strings: companies, products, or people named"],
  "sentiment": "one of: positive, negative, neutral, mixed"
}"""
ATTEMPT_SKIPPED = ": skipped (no API key configured)"
ATTEMPT_UNPARSEABLE = ": returned unparseable JSON"
ATTEMPT_SUCCESS = ": success"
ATTEMPTS_EXHAUSTED = "all providers exhausted"
ENRICHMENT_SKIPPED = "skipped: no full text available for this record"

# Flat export.
CELL_LIMIT = 5000
CELL_SUFFIX = "... [truncated]"
MAPPING_HEADER = ("raw_name", "canonical_name", "confidence")
UNCLASSIFIED = "Unclassified"
DASH = "—"
REVIEW_ROWS = 40

# Seed companies and their known name variants, in matching order.
SEED_NAMES = {
    "OpenAI": ["OpenAI, Inc.", "Open AI", "OpenAI Inc", "OpenAI Inc.", "openai.com"],
    "Anthropic": ["Anthropic PBC", "Anthropic, Inc.", "Anthropic Inc"],
    "Google DeepMind": ["DeepMind", "Google Deepmind", "DeepMind Technologies"],
    "Cohere": ["Cohere Inc", "Cohere AI", "Cohere Technologies"],
    "Mistral AI": ["Mistral", "MistralAI"],
    "Stability AI": ["Stability", "Stability.ai", "StabilityAI"],
    "Hugging Face": ["HuggingFace", "Hugging Face Inc", "Hugging Face, Inc."],
    "Scale AI": ["Scale", "ScaleAI", "Scale.ai"],
    "Perplexity AI": ["Perplexity", "Perplexity.ai"],
    "Character.AI": ["Character AI", "CharacterAI"],
    "Inflection AI": ["Inflection", "Inflection.ai"],
    "Adept AI": ["Adept", "Adept AI Labs"],
    "Runway": ["Runway AI", "Runway ML", "RunwayML"],
    "ElevenLabs": ["Eleven Labs", "11Labs", "11 Labs"],
    "Midjourney": ["Midjourney Inc", "Midjourney, Inc."],
    "Replit": ["Repl.it", "Replit Inc"],
    "Databricks": ["Databricks Inc", "Databricks, Inc."],
    "Weights & Biases": ["Weights and Biases", "WandB", "W&B"],
    "LangChain": ["Lang Chain", "LangChain AI"],
    "Pinecone": ["Pinecone Systems", "Pinecone.io"],
    "Together AI": ["Together", "Together Computer"],
    "Groq": ["Groq Inc", "Groq, Inc."],
    "Cerebras": ["Cerebras Systems"],
    "SambaNova": ["SambaNova Systems"],
    "Cursor": ["Anysphere", "Anysphere Inc"],
    "Glean": ["Glean Technologies", "Glean Work"],
    "Harvey": ["Harvey AI", "Harvey.ai"],
    "Sierra": ["Sierra AI", "Sierra.ai"],
    "Writer": ["Writer AI", "Writer.com", "Qordoba"],
    "Jasper": ["Jasper AI", "Jasper.ai"],
    "Synthesia": ["Synthesia Ltd", "Synthesia.io"],
    "Tavus": ["Tavus Inc", "Tavus.io"],
    "Suno": ["Suno AI", "Suno.ai"],
    "Udio": ["Udio AI", "Udio.com"],
    "Luma AI": ["Luma", "Luma Labs"],
    "Pika": ["Pika Labs", "Pika.art"],
    "Ideogram": ["Ideogram AI", "Ideogram.ai"],
    "Black Forest Labs": ["BlackForestLabs", "Black Forest Labs Inc"],
    "Krea AI": ["Krea", "Krea.ai"],
    "Codeium": ["Codeium Inc", "Exafunction"],
    "Magic": ["Magic AI", "Magic.dev"],
    "Imbue": ["Imbue AI", "Generally Intelligent"],
    "Reflection AI": ["Reflection", "Reflection.ai"],
    "xAI": ["X.AI", "X AI Corp"],
    "Figure AI": ["Figure", "Figure Robotics"],
    "Physical Intelligence": ["Physical Intelligence Inc", "Pi Robotics"],
    "Skild AI": ["Skild", "Skild.ai"],
    "World Labs": ["World Labs Inc"],
    "Decagon": ["Decagon AI", "Decagon.ai"],
    "Clay": ["Clay Labs", "Clay.com"],
    "Abridge": ["Abridge AI", "Abridge.com"],
}
