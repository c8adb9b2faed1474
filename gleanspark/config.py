"""Fixed values and source settings.

Every list is a default argument of the operator that uses it, so a caller can
pass another one.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: results depend on these exact words, domains and numbers. ---

RECENT_HOURS = 168
NAME_CHARS = 100
DESCRIPTION_CHARS = 400
HIT_NAME_CHARS = 80
EXCERPT_CHARS = 300
MIN_NAME_CHARS = 3
MIN_ANCHOR_CHARS = 4
MAX_CATEGORIES = 3

CATEGORY_TERMS: dict[str, list[str]] = {
    "images": ["image", "photo", "illustration", "visual", "artwork", "dall-e", "midjourney", "stable diffusion", "flux", "picture", "generate image"],
    "vidéo": ["video", "vidéo", "clip", "film", "animation", "cinematic", "reel", "short"],
    "voix": ["voice", "speech", "tts", "text-to-speech", "narration", "speak", "voice clone", "podcast"],
    "musique": ["music", "musique", "audio", "melody", "song", "beatmaker", "compose", "suno", "udio"],
    "chatbot": ["chat", "chatbot", "conversation", "assistant", "dialogue", "bot"],
    "texte": ["text", "texte", "writing", "copywriting", "article", "blog", "content", "paraphrase", "rewrite"],
    "documents": ["document", "pdf", "file", "report", "contract", "extract", "summarize"],
    "éducation": ["education", "learning", "teaching", "student", "teacher", "quiz", "flashcard", "cours", "tuteur", "e-learning"],
    "automatisation": ["automation", "workflow", "integration", "pipeline", "no-code", "zapier", "make", "n8n", "agentic", "agent"],
    "présentation": ["presentation", "slides", "powerpoint", "deck", "pitch deck"],
    "recherche": ["search", "research", "veille", "academic", "papers", "arxiv", "perplexity"],
    "données": ["data", "analytics", "chart", "csv", "excel", "visualization", "statistics", "dataset", "spreadsheet"],
    "LLM": ["llm", "language model", "llama", "mistral", "open weights", "fine-tun", "rag"],
    "open source": ["open source", "open-source", "github", "hugging face", "local model", "self-host"],
    "site web": ["website", "landing page", "web app", "builder", "no-code site", "html", "portfolio"],
    "images 3D": ["3d", "three-dimensional", "blender", "render", "3d model", "texture"],
    "mindmap": ["mindmap", "mind map", "brainstorm", "diagram", "concept map"],
    "infographie": ["infographic", "infographie", "graphic design", "poster", "banner", "canva", "flyer"],
    "langues": ["translation", "traduction", "multilingual", "foreign language", "subtitle", "caption"],
    "bande dessinée": ["comic", "manga", "bd", "strip", "graphic novel"],
    "histoires enfants": ["kids", "children", "enfant", "story", "conte", "jeunesse"],
    "navigateur": ["browser", "extension", "chrome", "firefox", "plugin browsing"],
    "jeu vidéo": ["game", "gaming", "rpg", "npc", "game level", "game character", "game asset"],
    "youtube": ["youtube", "yt", "youtube channel", "transcript", "video summary"],
    "qr code": ["qr", "qr code", "qrcode"],
    "quiz et flashcards": ["quiz", "flashcard", "revision", "memorization", "anki", "mcq"],
    "application": ["mobile app", "ios", "android", "app store"],
    "sans compte": ["no login", "no signup", "no account", "without account"],
    "usage illimité": ["unlimited", "illimité", "no limit", "infinite"],
    "actualités": ["news", "actualités", "fact-check", "journalism"],
}

FREE_TERMS = ["free", "gratuit", "no cost", "open source", "open-source", "100% free", "completely free", "always free"]
FREEMIUM_TERMS = ["freemium", "free plan", "free tier", "free trial", "free version", "free +", "basic free", "starter free"]
PRICING_TIERS = ["free", "freemium", "paid"]
UNKNOWN_PRICING = "unknown"

DIRECTORY_DOMAINS = [
    "theresanaiforthat.com", "free.theresanaiforthat.com", "futurepedia.io", "aiscout.net",
    "aiapp.fr", "iaweb.fr", "openfuture.ai", "ailibrary.io", "wikiaitools.com", "toolscout.ai",
    "hdrobots.com", "toolspedia.io", "madgenius.co", "aioftheday.com", "aitoolboard.com",
    "aitools.lol", "aitools.fyi", "ai-finder.net", "aitoolhunt.com", "aitoolnet.com", "dang.ai",
    "toolsstory.net", "free-ai-tools-directory.com", "aitoolguru.com", "noteableai.com",
    "faind.ai", "aicenter.ai", "bestfreeaiwebsites.com", "fastpedia.io", "bestofai.com",
    "futuretools.io", "aixploria.com", "aisecret.us", "aitoolsdirectory.com",
    "powerfulai.tools", "aitoptools.com", "aitools.sh", "toolify.ai",
    "producthunt.com", "therundown.ai", "beehiiv.com", "substack.com",
    "bensbites.com", "tldr.tech", "ycombinator.com", "algolia.com",
    "reddit.com", "redd.it", "github.com", "lobste.rs", "dev.to",
    "techcrunch.com", "venturebeat.com",
    "futuretools.link",
]
SOCIAL_DOMAINS = ["twitter.com", "x.com", "linkedin.com", "youtube.com", "facebook.com", "instagram.com", "threads.net"]
PRESS_DOMAINS = [
    "arxiv.org", "apnews.com", "reuters.com", "bloomberg.com", "nytimes.com",
    "wsj.com", "ft.com", "forbes.com", "techcrunch.com", "theverge.com",
    "wired.com", "axios.com", "cnbc.com", "businessinsider.com",
    "wikipedia.org", "finance.yahoo.com", "yahoo.com", "semafor.com",
    "theinformation.com", "arstechnica.com", "engadget.com",
    "venturebeat.com", "washingtonpost.com", "cnn.com", "bbc.com",
    "aisecret.us", "ghost.io",
]

TOPIC_TERMS = ["ai", "artificial intelligence", "machine learning", "llm", "gpt", "generative", "automation", "chatbot", "image generation", "voice", "neural"]
PRODUCT_TOPIC_TERMS = ["ai", "artificial intelligence", "machine learning", "llm", "gpt", "generative", "automation", "chatbot", "image", "voice", "neural", "agent"]
SHOW_TITLE_TERMS = [
    "ai", "gpt", "llm", "llama", "claude", "gemini", "generative", "neural",
    "image", "voice", "speech", "chatbot", "agent", "automat", "ml",
    "machine learning", "diffusion", "embedding", "rag", "copilot",
    "openai", "anthropic", "mistral", "model", "assistant", "bot",
]
SHOW_ARTICLE_PHRASES = ["the case for", "my experience", "deep dive", "state of the"]
SHOW_PATH_MARKERS = ["/blog/", "/posts/", "/post/", "/article/", "/news/", ".md", "/wiki/"]
SHOW_OWN_HOST = "ycombinator.com"
LAUNCH_TERMS = ["launch", "release", "introduces", "unveils", "announces", "rolls out", "new tool", "new app", "now available", "open source", "startup"]
LAUNCH_TITLE_TERMS = ["launch", "release", "introducing", "built", "show", "open source", "tool", "app", "library", "framework", "model", "demo"]

LISTING_CLASSES = {"row": "home-today-row", "name": "home-today-name-text", "tagline": "tools-name-tagline"}
LISTING_ATTRIBUTES = {"release_ts": "data-release-ts", "href": "data-href"}
ARTICLE_CONTAINER_CLASS = "gh-content"
SCRIPT_CHUNK_PREFIX = "self.__next_f.push"

TRIAGE_STATES = ["pending", "pub", "done", "ign"]
EXPORT_NO_DESCRIPTION = "(sans description)"
EXPORT_NO_VALUE = "—"
EXPORT_LABELS = {"categories": "Catégories : ", "source": "Source : ", "pricing": "Pricing : "}
EXPORT_RULE = "────────"
CATEGORY_SEPARATOR = " · "

# (display name, kind of payload) in arrival order; posts sources fall back to their feed.
NAMED_SOURCES = [
    ("Product Hunt", "product_feed"),
    ("Hacker News", "hits"),
    ("Aixploria", "posts"),
    ("FutureTools", "embedded"),
    ("There's an AI", "listing"),
    ("AI Secret", "newsletter"),
    ("Ben's Bites", "feed"),
    ("The Rundown AI", "feed"),
    ("TLDR AI", "feed"),
    ("TechCrunch AI", "launch_feed"),
    ("GitHub Trending", "feed"),
    ("Lobsters", "title_feed"),
    ("Best of AI", "sitemap"),
]
POSTS_DIRECTORIES = [
    "aiapp.fr", "iaweb.fr", "WikiAI Tools", "Notable AI", "AI Tool Guru", "Best Free AI",
    "HD Robots", "Mad Genius", "AI Tools LOL", "AI Tool Hunt", "AI Tool Board", "Fastpedia",
]
CAPS = {
    "Product Hunt": 30, "AI Secret": 5, "Ben's Bites": 20, "The Rundown AI": 20, "TLDR AI": 20,
    "TechCrunch AI": 20, "GitHub Trending": 15, "Lobsters": 25, "Best of AI": 25, "Hacker News": 20,
}
DEFAULT_FEED_CAP = 30
HITS_PER_PAGE = 50
POSTS_PER_PAGE = 20
TOPIC_FILTERED = ["Ben's Bites", "GitHub Trending"]

# --- End of fixed values. ---


@dataclass(frozen=True)
class SourceSpec:
    """One source: its name, arrival rank, payload kind, row cap and word filter."""

    name: str
    rank: int
    kind: str
    cap: int
    topic_filter: bool = False
    fallback_cap: int | None = None


def make_spec(name: str, rank: int, kind: str) -> SourceSpec:
    """Settings of one source; posts sources get a capped feed to fall back to."""
    default_cap = POSTS_PER_PAGE if kind == "posts" else DEFAULT_FEED_CAP
    return SourceSpec(
        name=name,
        rank=rank,
        kind=kind,
        cap=CAPS.get(name, default_cap),
        topic_filter=name in TOPIC_FILTERED,
        fallback_cap=DEFAULT_FEED_CAP if kind == "posts" else None,
    )


def default_sources() -> list[SourceSpec]:
    """All 25 sources in arrival order."""
    named = NAMED_SOURCES + [(name, "posts") for name in POSTS_DIRECTORIES]
    return [make_spec(name, rank, kind) for rank, (name, kind) in enumerate(named)]
