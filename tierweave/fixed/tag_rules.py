"""Rules of tag inference: text patterns and field-value tables, in rule order."""

# Case-insensitive pattern -> tags added when it is found in the text.
TEXT_RULES = (
    # technology
    (r"\btransformer\b", ["transformer"]),
    (r"\bdiffusion\b", ["diffusion-model"]),
    (r"\b(?:retrieval.augmented|rag)\b", ["rag"]),
    (r"\bmultimodal\b", ["multimodal"]),
    (r"\bnlp\b|\bnatural language\b", ["nlp"]),
    (r"\bcomputer vision\b|\bimage recognition\b|\bobject detection\b", ["computer-vision"]),
    (r"\breinforcement learning\b", ["reinforcement-learning"]),
    (r"\bfine.?tun(?:e|ing)\b", ["fine-tuning"]),
    (r"\bembedding(?:s)?\b|\bvector(?:s)?\b", ["embedding"]),
    (r"\bspeech.to.text\b|\bspeech recognition\b|\btranscri(?:be|ption)\b|\basr\b", ["speech-to-text"]),
    (r"\btext.to.image\b|\bimage generat(?:e|ion|or)\b", ["text-to-image"]),
    (r"\btext.to.video\b|\bvideo generat(?:e|ion|or)\b", ["text-to-video"]),
    (r"\btext.to.speech\b|\btts\b|\bvoice (?:generat|synthe|clon)", ["text-to-speech"]),
    (r"\btext.to.3d\b|\b3d generat(?:e|ion)\b", ["text-to-3d"]),
    (r"\btext.to.music\b|\bmusic generat(?:e|ion)\b", ["text-to-music"]),
    (r"\bcode generat(?:e|ion|or)\b|\bcoding assist\b|\bcode complet(?:e|ion)\b", ["code-generation"]),
    (r"\bprompt engineer(?:ing)?\b", ["prompt-engineering"]),
    (r"\bimage.to.video\b", ["image-to-video"]),
    (r"\bgraph neural\b|\bgnn\b", ["graph-neural-network"]),
    (r"\bneuro.symbolic\b", ["neuro-symbolic"]),
    (r"\bmixture.of.experts\b|\bmoe\b", ["moe"]),
    (r"\bquantiz(?:e|ation)\b", ["quantization"]),
    (r"\bdistill(?:ation|ed)\b", ["distillation"]),
    (r"\bfederated learning\b", ["federated-learning"]),
    # use case
    (r"\bchatbot\b|\bchat bot\b|\bchat assistant\b|\bconversational ai\b", ["chatbot"]),
    (r"\bcopilot\b|\bcoding assistant\b|\bcode assistant\b|\bpair program", ["copilot"]),
    (r"\bwriting assist\b|\bai writ(?:e|er|ing)\b|\bcopywriting\b", ["writing-assistant"]),
    (r"\bdata analy(?:sis|tics)\b|\bdata visual", ["data-analysis"]),
    (r"\bcontent creat(?:e|ion|or)\b", ["content-creation"]),
    (r"\bcustomer (?:support|service)\b|\bhelpdesk\b", ["customer-support"]),
    (r"\bsearch engine\b|\bai search\b", ["search-engine"]),
    (r"\bworkflow automat(?:e|ion)\b|\bprocess automat", ["workflow-automation"]),
    (r"\bmarketing\b|\bad (?:generat|creat|campaign)", ["marketing"]),
    (r"\btranslat(?:e|ion|or)\b", ["translation"]),
    (r"\bmeeting (?:note|summar|transcript)\b", ["meeting-notes"]),
    (r"\bdesign\b.{0,100}\b(?:ai|tool|creative)\b|\bai.{0,100}\bdesign\b", ["design-creative"]),
    (r"\bphoto edit(?:ing|or)\b|\bimage edit(?:ing|or)\b", ["photo-editing"]),
    (r"\bvideo edit(?:ing|or)\b", ["video-editing"]),
    (r"\bvoice assistant\b", ["voice-assistant"]),
    (r"\bpersonal assistant\b", ["personal-assistant"]),
    (r"\bknowledge (?:base|graph|manag)\b", ["knowledge-base"]),
    (r"\bresearch (?:tool|assist|platform)\b|\bscientific research\b", ["research"]),
    (r"\btesting\b.{0,100}\bqa\b|\btest automat\b|\bquality assurance\b", ["testing-qa"]),
    (r"\bcode review\b", ["code-review"]),
    (r"\bpresentation\b|\bslide(?:s)?\b", ["presentation"]),
    (r"\bemail\b.{0,100}\b(?:ai|assist|generat|automat)\b", ["email"]),
    (r"\bsales\b.{0,100}\bcrm\b|\bcrm\b.{0,100}\bsales\b|\bsales (?:assist|automat|tool)\b", ["sales-crm"]),
    (r"\b(?:hr|recruit|hiring|talent)\b", ["hr-recruiting"]),
    (r"\bproject manag\b", ["project-management"]),
    (r"\bcontent moderat\b", ["content-moderation"]),
    (r"\bsocial media\b", ["social-media"]),
    (r"\blegal\b.{0,100}\b(?:ai|assist|tool)\b", ["legal-assist"]),
    (r"\bfinance\b|\baccounting\b|\bfinancial\b", ["finance-accounting"]),
    (r"\beducat(?:e|ion|ional)\b|\btutoring\b|\blearning platform\b", ["education-tutoring"]),
    # domain
    (r"\bhealthcare\b|\bmedical\b|\bhealth\b.{0,100}\bai\b", ["healthcare"]),
    (r"\bdrug discover|\bpharma(?:ceut(?:ical)?)?\b", ["drug-discovery"]),
    (r"\bmedical imag\b|\bradiology\b|\bdiagnostic imag", ["medical-imaging"]),
    (r"\bprotein (?:fold|struct|predict)\b|\balphafold\b", ["protein-folding"]),
    (r"\btrading\b|\bstock\b|\bfintech\b", ["trading"]),
    (r"\brisk (?:assess|manag)\b", ["risk-assessment"]),
    (r"\bfraud detect\b", ["fraud-detection"]),
    (r"\bgaming\b|\bgame\b.{0,100}\bai\b|\bai.{0,100}\bgame\b", ["gaming"]),
    (r"\bdefense\b|\bmilitary\b", ["defense"]),
    (r"\bclimate\b|\benergy\b|\bsustainab\b|\bcarbon\b", ["climate-energy"]),
    (r"\bmaterials? science\b", ["materials-science"]),
    (r"\bclinical trial\b", ["clinical-trials"]),
    (r"\bautonomous vehicl|\bself.driving\b|\bautonomous driv", ["autonomous-vehicles", "self-driving"]),
    (r"\brobot(?:ic)?s?\b", ["robotics"]),
    (r"\bhumanoid\b", ["humanoid-robot"]),
    (r"\bdrone\b|\buav\b", ["drone"]),
    # business model
    (r"\bopen.?source\b", ["open-source"]),
    (r"\bapi\b.{0,100}\b(?:service|platform|access)\b|\brest api\b", ["api-service"]),
    (r"\bsaas\b", ["saas"]),
    (r"\bfree(?:mium| tier| plan)\b", ["freemium"]),
    (r"\bself.hosted\b|\bon.premise\b", ["self-hosted"]),
    (r"\bcloud.native\b", ["cloud-native"]),
    # audience
    (r"\bfor developer\b|\bdeveloper tool\b|\bdev tool\b", ["developers"]),
    (r"\bdata scien(?:ce|tist)\b|\bmachine learning engineer\b", ["data-scientists"]),
    (r"\benterprise\b", ["enterprises"]),
    (r"\bresearcher\b|\bacademi\b", ["researchers"]),
    (r"\bcreator\b|\bartist\b", ["creators"]),
    # technical
    (r"\breal.time\b", ["real-time"]),
    (r"\blow.latency\b", ["low-latency"]),
    (r"\bon.device\b", ["on-device"]),
    (r"\bedge ai\b|\bedge (?:comput|deploy)\b", ["edge-ai"]),
    (r"\bmobile app\b|\bios\b.{0,100}\bandroid\b|\bandroid\b.{0,100}\bios\b", ["mobile-app"]),
    (r"\bdesktop app\b|\belectron\b|\bnative app\b", ["desktop-app"]),
    (r"\bbrowser extension\b|\bchrome extension\b", ["browser-extension"]),
    (r"\bsdk\b", ["sdk"]),
    (r"\bcli\b|\bcommand.line\b", ["cli-tool"]),
)

# Category -> tags.
CATEGORY_TAGS = {
    "ai-foundation-model": ["nlp", "researchers"],
    "ai-application": ["consumers"],
    "ai-creative-media": ["creators", "content-creation"],
    "ai-dev-platform": ["developers"],
    "ai-infrastructure": ["developers", "enterprises"],
    "ai-data-platform": ["data-analysis", "data-scientists"],
    "ai-search-retrieval": ["search-engine"],
    "ai-hardware": ["robotics"],
    "ai-security-governance": ["enterprises"],
    "ai-science-research": ["researchers", "research"],
    "ai-enterprise-vertical": ["enterprises", "b2b"],
}

# Sub-category -> tags.
SUB_CATEGORY_TAGS = {
    "text-generation": ["nlp", "chatbot"],
    "image-generation": ["text-to-image", "diffusion-model"],
    "video-generation": ["text-to-video"],
    "audio-speech": ["text-to-speech"],
    "music-generation": ["text-to-music"],
    "3d-generation": ["text-to-3d"],
    "coding-assistant": ["code-generation", "copilot", "developers"],
    "multi-agent-platform": ["developers"],
    "healthcare-medical": ["healthcare"],
    "education-tutoring": ["education", "education-tutoring"],
    "finance-accounting": ["finance", "finance-accounting"],
    "legal": ["legal", "legal-assist"],
    "research-paper": ["research", "researchers"],
    "data-labeling": ["data-scientists"],
    "model-serving": ["api-service", "developers"],
    "vector-database": ["embedding", "developers"],
}

# Product type -> tags.
PRODUCT_TYPE_TAGS = {
    "app": ["consumers"],
    "model": ["researchers", "developers"],
    "library": ["developers", "sdk"],
    "framework": ["developers"],
    "platform": ["enterprises"],
    "api": ["developers", "api-service", "api-platform"],
    "dataset": ["researchers", "data-scientists"],
}

# Substring of a platform name -> tag, in test order.
PLATFORM_TAGS = {
    "ios": "mobile-app",
    "android": "mobile-app",
    "web": "saas",
    "desktop": "desktop-app",
    "browser-extension": "browser-extension",
    "api": "api-platform",
    "cli": "cli-tool",
}

# Pricing model -> tag.
PRICING_TAGS = {
    "freemium": "freemium",
    "open-source": "open-source",
    "usage-based": "usage-based",
    "enterprise": "enterprise",
}

# Substrings of the architecture field -> tag, in test order.
ARCHITECTURE_TAGS = (
    (("transformer",), "transformer"),
    (("moe", "mixture"), "moe"),
    (("diffusion",), "diffusion-model"),
    (("cnn", "convolut"), "computer-vision"),
)

# Valuation limits in USD.
DECACORN_USD = 10_000_000_000
UNICORN_USD = 1_000_000_000
