"""Tables of the company-to-product and the category/tag migrations."""

# Company category -> product category.
OLD_CATEGORY = {
    "llm-foundation-model": "ai-model",
    "ai-coding": "ai-dev-tool",
    "ai-image-video": "ai-model",
    "ai-audio-speech": "ai-model",
    "ai-search": "ai-search",
    "ai-robotics": "ai-hardware",
    "ai-infrastructure": "ai-infrastructure",
    "ai-data-analytics": "ai-data",
    "ai-assistant": "ai-app",
    "ai-enterprise": "ai-app",
    "autonomous-vehicles": "ai-hardware",
    "ai-security-defense": "ai-security",
    "ai-healthcare": "ai-app",
    "ai-education": "ai-app",
    "ai-finance": "ai-app",
    "ai-gaming": "ai-app",
    "ai-other": "ai-app",
}

# Company category -> sub-category (two have none).
OLD_SUB_CATEGORY = {
    "llm-foundation-model": "text-generation",
    "ai-coding": "coding-assistant",
    "ai-image-video": "image-generation",
    "ai-audio-speech": "audio-speech",
    "ai-search": "web-search",
    "ai-robotics": "robot",
    "ai-infrastructure": "compute-platform",
    "ai-data-analytics": "data-pipeline",
    "ai-assistant": "personal-assistant",
    "ai-enterprise": "workflow-automation",
    "autonomous-vehicles": "autonomous-vehicle",
    "ai-security-defense": "ai-safety",
    "ai-healthcare": "healthcare-medical",
    "ai-education": "education-tutoring",
    "ai-finance": "finance-accounting",
}

# Company category -> product type.
OLD_PRODUCT_TYPE = {
    "llm-foundation-model": "llm",
    "ai-coding": "dev-tool",
    "ai-image-video": "llm",
    "ai-audio-speech": "llm",
    "ai-search": "app",
    "ai-robotics": "hardware",
    "ai-infrastructure": "api-service",
    "ai-data-analytics": "dev-tool",
    "ai-assistant": "app",
    "ai-enterprise": "app",
    "autonomous-vehicles": "hardware",
    "ai-security-defense": "app",
    "ai-healthcare": "app",
    "ai-education": "app",
    "ai-finance": "app",
    "ai-gaming": "app",
    "ai-other": "other",
}

# Company status -> product status.
OLD_STATUS = {
    "active": "active", "acquired": "active", "shut-down": "discontinued", "ipo": "active",
}

# Slugs that are archived, not migrated.
ARCHIVED_SLUGS = (
    "stealth-startup", "stealth-ai-startup", "avance-consulting", "praxent", "enableit",
    "azumo", "centerline-logistics-corporation", "dixon-group-europe-ltd-middle-east",
    "grassroots-carbon", "prana-tree", "crossing-hurdles", "fionics", "leotech", "netic",
    "cymertek-corporation", "tinder", "handshake", "netflix", "honeywell", "linkedin",
    "point72", "ecosave", "energize-group", "erg", "cis", "giga", "middesk",
    "art-of-hacking",
)

# Source-internal tags dropped by the company migration.
SOURCE_TAGS = ("linkedin", "github-scraper")

# Job-board leftovers removed from text.
JOB_BOARD_PATTERN = (
    r"\d+\s*days?\s*ago|Actively\s*Hiring|Apply\s*Now|Click|\d+\s*hours?\s*ago|Posted\s*\d+"
    r"|Easy\s*Apply|\d+\s*weeks?\s*ago|\d+\s*months?\s*ago|\+\d+\s*benefits?"
)

# Earlier category -> current category, one to one.
CATEGORY_RENAMES = {
    "ai-infrastructure": "ai-infrastructure",
    "ai-dev-tool": "ai-dev-platform",
    "ai-data": "ai-data-platform",
    "ai-search": "ai-search-retrieval",
    "ai-security": "ai-security-governance",
    "ai-science": "ai-science-research",
    "ai-hardware": "ai-hardware",
}

# What makes a model a media product, an agent a platform, an app a vertical.
MEDIA_SUB_CATEGORIES = (
    "image-generation", "video-generation", "audio-speech", "music-generation", "3d-generation",
)
MEDIA_TAGS = (
    "text-to-image", "text-to-video", "text-to-speech", "text-to-3d", "text-to-music",
    "image-to-video", "diffusion-model",
)
AGENT_PLATFORM_SUB_CATEGORIES = ("multi-agent-platform", "coding-agent")
VERTICAL_SUB_CATEGORIES = (
    "healthcare-medical", "education-tutoring", "finance-accounting", "legal",
)

# Renamed tags.
TAG_RENAMES = {
    "developer-tools": "developers",
    "open-weights": "open-source",
    "ai-chatbots": "chatbot",
}
