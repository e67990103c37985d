"""Lookup tables and patterns of the source mappers."""

# Listing slug -> (product type, category, sub-category).
TOOLIFY_CATEGORIES = {
    "ai-chatbot": ("app", "ai-app", "voice-assistant"),
    "ai-writing": ("app", "ai-app", "writing-copywriting"),
    "ai-image": ("app", "ai-app", "design-creative"),
    "ai-video": ("app", "ai-app", "video-editing"),
    "ai-code": ("dev-tool", "ai-dev-tool", "coding-assistant"),
    "ai-audio": ("app", "ai-app", "audio-speech"),
    "ai-design": ("app", "ai-app", "design-creative"),
    "ai-marketing": ("app", "ai-app", "marketing"),
    "ai-search": ("app", "ai-search", None),
    "ai-productivity": ("app", "ai-app", "workflow-automation"),
    "ai-education": ("app", "ai-app", "education-tutoring"),
    "ai-data-analysis": ("app", "ai-data", "data-analysis"),
    "ai-developer-tools": ("dev-tool", "ai-dev-tool", "ai-framework"),
    "ai-customer-service": ("app", "ai-app", "customer-service"),
    "ai-healthcare": ("app", "ai-science", "healthcare-medical"),
    "ai-finance": ("app", "ai-app", "finance-accounting"),
    "ai-music": ("app", "ai-app", "music-generation"),
    "ai-3d": ("app", "ai-app", "3d-generation"),
    "ai-translation": ("app", "ai-app", "translation"),
}
AIBOT_CATEGORIES = {
    "ai-chatbots": ("app", "ai-app", "voice-assistant"),
    "ai-writing-tools": ("app", "ai-app", "writing-copywriting"),
    "ai-image-tools": ("app", "ai-app", "design-creative"),
    "ai-video-tools": ("app", "ai-app", "video-editing"),
    "ai-audio-tools": ("app", "ai-app", "audio-speech"),
    "ai-coding-tools": ("dev-tool", "ai-dev-tool", "coding-assistant"),
    "ai-design-tools": ("app", "ai-app", "design-creative"),
    "ai-office-tools": ("app", "ai-app", "workflow-automation"),
    "ai-search-engine": ("app", "ai-search", None),
    "ai-model-training": ("framework", "ai-infrastructure", None),
}
AINAV_CATEGORIES = {
    "ai对话聊天": ("app", "ai-app", "voice-assistant"),
    "ai文本写作": ("app", "ai-app", "writing-copywriting"),
    "ai绘画生成": ("app", "ai-app", "design-creative"),
    "ai视频工具": ("app", "ai-app", "video-editing"),
    "ai音频工具": ("app", "ai-app", "audio-speech"),
    "ai图片处理": ("app", "ai-app", "design-creative"),
    "ai编程工具": ("dev-tool", "ai-dev-tool", "coding-assistant"),
    "ai办公工具": ("app", "ai-app", "workflow-automation"),
    "ai搜索引擎": ("app", "ai-search", None),
    "ai训练模型": ("framework", "ai-infrastructure", None),
}
TAAFT_CATEGORIES = {
    "text-generators": ("llm", "ai-model", "text-generation"),
    "image-generators": ("app", "ai-app", "image-generation"),
    "video-generators": ("app", "ai-app", "video-generation"),
    "code-assistants": ("dev-tool", "ai-dev-tool", "coding-assistant"),
    "chatbots": ("app", "ai-app", "voice-assistant"),
    "writing-assistants": ("app", "ai-app", "writing-copywriting"),
    "marketing": ("app", "ai-app", "marketing"),
    "productivity": ("app", "ai-app", None),
    "music-generators": ("app", "ai-app", "music-generation"),
    "search-engines": ("app", "ai-search", "ai-search"),
    "data-analysis": ("app", "ai-data", "data-analysis"),
    "education": ("app", "ai-app", "education-tutoring"),
    "design": ("app", "ai-app", "design-creative"),
    "developer-tools": ("dev-tool", "ai-dev-tool", "ai-framework"),
    "customer-support": ("app", "ai-app", "customer-service"),
    "healthcare": ("app", "ai-science", "healthcare-medical"),
    "finance": ("app", "ai-app", "finance-accounting"),
    "legal": ("app", "ai-app", "legal"),
    "speech": ("app", "ai-app", "audio-speech"),
    "audio": ("app", "ai-app", "audio-speech"),
    "3d": ("app", "ai-app", "3d-generation"),
    "robotics": ("hardware", "ai-hardware", "robot"),
    "autonomous-vehicles": ("hardware", "ai-hardware", "autonomous-vehicle"),
    "cybersecurity": ("app", "ai-security", "ai-security"),
    "gaming": ("app", "ai-app", None),
}

# Link texts that are navigation, not listings.
TOOLIFY_NAV = (
    "home", "about", "blog", "contact", "login", "sign up", "pricing", "privacy", "terms",
    "cookie", "faq", "all categories", "more tools", "load more", "next", "previous",
    "toolify", "submit", "categories",
)
TAAFT_NAV = (
    "home", "about", "blog", "contact", "login", "sign up", "pricing", "privacy", "terms",
    "cookie", "faq", "help", "twitter", "linkedin", "facebook", "github", "discord",
    "newsletter", "submit", "categories", "all tools", "more", "load more", "next",
    "previous", "back",
)
JOB_NAV = ("首页", "登录", "注册", "搜索", "推荐", "热门", "---", "职位", "公司")
JOB_HEADERS = ("职位", "岗位", "公司", "企业", "job", "company", "---", "title")

# Listing patterns.
TOOLIFY_ENTRY = (
    r"(?mi)(?:^|\n)(?:\d+[\.\)]\s*)?\[([^\]]{2,80})\]\((https?://[^\s)]+)\)[^\n]*?"
    r"(?:(\d[\d,.]*[KMB]?)\s*(?:monthly\s*visits?|visits?/mo|visits?))?[^\n]*\n([^\n]{10,500})?"
)
HEADING_ENTRY = (
    r"(?m)#{1,4}\s+\[?([^\]\n#]{2,80})\]?(?:\((https?://[^\s)]+)\))?\s*\n+([^\n#]{10,500})"
)
TAAFT_ENTRY = r"(?m)\[([^\]]{2,80})\]\((https?://[^\s)]+)\)[^\n]*\n+([^\n]{10,500})"
AIBOT_CARD = (
    r"""(?is)<a[^>]*href=["']([^"']+)["'][^>]*title=["']([^"']*)["'][^>]*>.*?"""
    r"""<strong[^>]*>\s*([^<]{2,80})\s*</strong>"""
)
AIBOT_LINK = (
    r"""(?is)<a[^>]*href=["'](/sites/\d+\.html)["'][^>]*>\s*(?:<[^>]*>)*\s*([^<]{2,80})\s*"""
    r"""(?:</[^>]*>)*\s*</a>"""
)
AINAV_CARD = (
    r"""(?is)<a[^>]*href=["']([^"']*?/sites/\d+\.html)["'][^>]*data-url=["']([^"']*)["']"""
    r"""[^>]*title=["']([^"']*)["'][^>]*>.*?<strong[^>]*>\s*([^<]{2,80})\s*</strong>"""
)
CARD_ICON = r"""(?i)<img[^>]*src=["']([^"']+)["'][^>]*/?>"""
TC_LINK = r"(?m)\[([^\]]{10,150})\]\((https://techcrunch\.com/\d{4}/\d{2}/\d{2}/[^\s)]+)\)"
TC_HEADING = r"(?m)#{1,3}\s+\[?([^\]\n#]{10,150})\]?(?:\((https://techcrunch\.com/[^\s)]+)\))?"
TC_COMPANY = (
    r"(?i)^([A-Z][A-Za-z0-9\s.&'-]{1,40}?)\s+"
    r"(?:raises?|secures?|closes?|lands?|gets?|launches?|announces?|unveils?|introduces?)"
)
TC_FUNDING = (
    r"(?i)(?:raises?|raised|secures?|secured|closes?|closed|lands?|landed|gets?|got)\s+"
    r"\$?([\d,.]+)\s*(million|billion|M|B)\s*(?:in\s+)?"
    r"(Series\s+[A-Z]\+?|Seed|Pre-Seed|Angel|growth|venture|debt|convertible|extension|bridge)?"
    r"\s*(?:round|funding|financing)?"
)
TC_DATE = r"/(\d{4})/(\d{2})/(\d{2})/"
AA_ROW = (
    r"(?m)\|\s*\[?([^\]|]{2,60})\]?(?:\([^)]*\))?\s*\|\s*([^|]{1,40})\s*\|"
    r"\s*([0-9]+\.?[0-9]*)\s*\|\s*([0-9,]+\.?[0-9]*)\s*\|\s*\$?([0-9]+\.?[0-9]*)\s*\|"
)
AA_SIMPLE = (
    r"(?mi)(?:^|\n)(?:\d+[\.\)]\s*)?\[?([A-Za-z][^\]\n|]{2,60})\]?(?:\([^)]*\))?\s*[|:]\s*.*?"
    r"(\d+\.?\d*)\s*(?:tok(?:en)?s?/s|t/s|tokens per second)"
)
PWC_ROW = (
    r"(?m)\|\s*\[?([^\]|]{2,80})\]?(?:\((/paper/[^\s)]+)\))?\s*\|\s*([0-9]+\.?[0-9]*)\s*\|"
)
PWC_ENTRY = (
    r"(?m)(?:^|\n)\d+\.\s+\[?([^\]\n]{2,80})\]?(?:\((https?://[^\s)]+)\))?[^\n]*?(\d+\.?\d*)\s*$"
)
CB_FUNDING = r"(?i)(?:Total Funding|Funding Total)[:\s]*\$?([\d,.]+[MBK]?)"
CB_VALUATION = r"(?i)(?:Valuation|Post-Money Valuation)[:\s]*\$?([\d,.]+[MBT]?)"
CB_ROUND = (
    r"(?i)(?:Last Funding Type|Latest Round)[:\s]*(Series [A-Z]|Seed|Pre-Seed|IPO|Grant|Debt"
    r"|Convertible|Growth|Venture|Angel|Private Equity)"
)
CB_EMPLOYEES = r"(?i)(?:Number of Employees|Employees)[:\s]*([\d,]+-[\d,]+|[\d,]+\+?)"
CB_FOUNDED = r"(?i)(?:Founded Date|Founded)[:\s]*(\d{4})"
CB_HQ = r"(?i)(?:Headquarters|HQ)[:\s]*([^|\n]+)"
CB_INVESTORS = r"(?i)(?:Investors?|Key Investors?)[:\s]*([^\n]+)"
JOB_HEADING = (
    r"(?m)(?:^|\n)#{1,4}\s+\[?([^\]\n]{3,60})\]?(?:\([^)]*\))?\s*\n([^\n]{2,40})"
    r"(?:\s*[·|•\-]\s*([^\n]{2,30}))?(?:\s*[·|•\-]\s*([^\n]{2,30}))?"
)
JOB_TABLE = r"(?m)\|\s*([^|]{3,50})\s*\|\s*([^|]{2,40})\s*\|\s*([^|]{2,30})\s*\|"
JOB_CARD = (
    r"(?m)\*\*([^*]{3,60})\*\*\s*\n\s*([^\n·|•\-]{2,40})(?:\s*[·|•\-]\s*([^\n]{2,30}))?"
)
SALARY = r"\d+[kK万]|\d+-\d+|\d+薪|面议"

# Benchmark page slug -> benchmark name, in page order.
BENCHMARK_PAGES = {
    "language-modelling-on-wikitext-103": "WikiText-103_Perplexity",
    "question-answering-on-squad20": "SQuAD2.0_F1",
    "machine-translation-on-wmt2014-english-german": "WMT14_en-de_BLEU",
    "image-classification-on-imagenet": "ImageNet_Top1",
    "object-detection-on-coco": "COCO_mAP",
    "text-generation-on-mmlu": "MMLU",
    "multi-task-language-understanding-on-mmlu": "MMLU",
    "code-generation-on-humaneval": "HumanEval_pass@1",
    "math-word-problem-solving-on-gsm8k": "GSM8K",
    "common-sense-reasoning-on-hellaswag": "HellaSwag",
    "reading-comprehension-on-arc-challenge": "ARC-Challenge",
    "visual-question-answering-on-vqa-v2": "VQA-v2",
    "text-to-image-generation-on-coco": "COCO_FID",
    "speech-recognition-on-librispeech-test-clean": "LibriSpeech_WER",
}

# Model name fragment -> organisation, first hit in this order wins.
ARENA_ORGS = {
    "gpt-4": "OpenAI", "gpt-4o": "OpenAI", "gpt-4-turbo": "OpenAI", "gpt-3.5-turbo": "OpenAI",
    "claude-3": "Anthropic", "claude-3-opus": "Anthropic", "claude-3-sonnet": "Anthropic",
    "claude-3-haiku": "Anthropic", "claude-3.5-sonnet": "Anthropic", "claude-2": "Anthropic",
    "gemini-pro": "Google", "gemini-ultra": "Google", "gemini-1.5-pro": "Google",
    "llama-2": "Meta", "llama-3": "Meta", "llama-3.1": "Meta",
    "mistral": "Mistral AI", "mixtral": "Mistral AI", "yi": "01.AI",
    "qwen": "Alibaba Cloud", "deepseek": "DeepSeek", "command-r": "Cohere",
    "dbrx": "Databricks", "phi-3": "Microsoft", "phi-4": "Microsoft",
    "wizardlm": "Microsoft", "vicuna": "LMSYS", "chatglm": "Zhipu AI", "glm-4": "Zhipu AI",
    "baichuan": "Baichuan Inc.", "internlm": "Shanghai AI Lab",
}
PAPER_ORGS = {
    "gpt": "OpenAI", "claude": "Anthropic", "gemini": "Google DeepMind", "llama": "Meta",
    "mistral": "Mistral AI", "qwen": "Alibaba", "deepseek": "DeepSeek", "phi": "Microsoft",
    "yi": "01.AI", "command": "Cohere", "falcon": "Technology Innovation Institute",
    "palm": "Google", "chinchilla": "DeepMind", "bloom": "BigScience",
    "stable diffusion": "Stability AI", "dall-e": "OpenAI", "whisper": "OpenAI",
}
PROVIDERS = {
    "openai": "OpenAI", "anthropic": "Anthropic", "google": "Google DeepMind", "meta": "Meta",
    "mistral": "Mistral AI", "cohere": "Cohere", "deepseek": "DeepSeek", "alibaba": "Alibaba",
    "01.ai": "01.AI", "microsoft": "Microsoft", "amazon": "Amazon", "nvidia": "NVIDIA",
    "together": "Together AI", "anyscale": "Anyscale", "groq": "Groq",
    "fireworks": "Fireworks AI",
}
MODEL_PREFIX_ORGS = {
    "gpt": "OpenAI", "claude": "Anthropic", "gemini": "Google DeepMind", "llama": "Meta",
    "mistral": "Mistral AI", "qwen": "Alibaba", "deepseek": "DeepSeek", "phi": "Microsoft",
    "command": "Cohere",
}
ROUTER_ORGS = {
    "openai/": "OpenAI", "anthropic/": "Anthropic", "google/": "Google",
    "meta-llama/": "Meta", "mistralai/": "Mistral AI", "deepseek/": "DeepSeek",
    "cohere/": "Cohere", "microsoft/": "Microsoft", "qwen/": "Alibaba Cloud",
    "01-ai/": "01.AI", "databricks/": "Databricks", "nvidia/": "NVIDIA",
    "amazon/": "Amazon", "perplexity/": "Perplexity", "x-ai/": "xAI",
    "nousresearch/": "Nous Research",
}
HUB_ORGS = {
    "meta-llama": "Meta", "google": "Google", "microsoft": "Microsoft", "openai": "OpenAI",
    "mistralai": "Mistral AI", "Qwen": "Alibaba Cloud", "deepseek-ai": "DeepSeek",
    "01-ai": "01.AI", "THUDM": "Tsinghua University", "bigscience": "BigScience",
    "EleutherAI": "EleutherAI", "stabilityai": "Stability AI",
    "black-forest-labs": "Black Forest Labs", "HuggingFaceH4": "Hugging Face",
    "tiiuae": "Technology Innovation Institute", "NousResearch": "Nous Research",
    "databricks": "Databricks", "CohereForAI": "Cohere", "allenai": "Allen Institute for AI",
    "BAAI": "Beijing Academy of AI",
}

# Open and closed model families by name prefix.
CLOSED_PREFIXES = ("gpt-", "claude-", "gemini-", "o1-", "o3-")
OPEN_PREFIXES = (
    "llama", "mistral", "mixtral", "qwen", "deepseek", "yi-", "phi-", "vicuna", "falcon",
    "mpt-", "olmo", "gemma",
)

# Hub task -> sub-category, hub task -> product type, licence tag -> SPDX id.
TASK_SUB_CATEGORY = {
    "text-generation": "text-generation", "text2text-generation": "text-generation",
    "text-classification": "text-generation", "fill-mask": "text-generation",
    "question-answering": "text-generation", "summarization": "text-generation",
    "translation": "text-generation", "conversational": "text-generation",
    "image-classification": "image-generation", "image-to-text": "image-generation",
    "text-to-image": "image-generation", "image-segmentation": "image-generation",
    "object-detection": "image-generation", "text-to-video": "video-generation",
    "text-to-audio": "audio-speech", "text-to-speech": "audio-speech",
    "automatic-speech-recognition": "audio-speech", "audio-classification": "audio-speech",
    "feature-extraction": "embedding", "sentence-similarity": "embedding",
    "zero-shot-classification": "multimodal", "visual-question-answering": "multimodal",
    "document-question-answering": "multimodal", "image-text-to-text": "multimodal",
}
TASK_PRODUCT_TYPE = {
    "text-generation": "llm", "text2text-generation": "llm", "conversational": "llm",
    "fill-mask": "llm", "text-to-image": "other", "image-classification": "other",
    "image-to-text": "other", "image-segmentation": "other", "object-detection": "other",
    "text-to-audio": "other", "text-to-speech": "other",
    "automatic-speech-recognition": "other", "audio-classification": "other",
    "text-to-video": "other", "feature-extraction": "framework",
    "sentence-similarity": "framework",
}
LICENSES = {
    "apache-2.0": "Apache-2.0", "mit": "MIT", "gpl-3.0": "GPL-3.0-only",
    "cc-by-4.0": "CC-BY-4.0", "cc-by-nc-4.0": "CC-BY-NC-4.0", "cc-by-sa-4.0": "CC-BY-SA-4.0",
    "cc-by-nc-sa-4.0": "CC-BY-NC-SA-4.0", "openrail": "OpenRAIL", "openrail++": "OpenRAIL++",
    "llama2": "Llama-2", "llama3": "Llama-3", "llama3.1": "Llama-3.1",
    "llama3.2": "Llama-3.2", "gemma": "Gemma",
    "bigscience-bloom-rail-1.0": "BLOOM-RAIL-1.0",
}
# Modality pair -> hub tasks.
TASK_MODALITIES = (
    (("text",), (
        "text-generation", "text2text-generation", "text-classification", "fill-mask",
        "question-answering", "summarization", "translation", "conversational",
        "sentence-similarity",
    )),
    (("image", "text"), (
        "image-classification", "image-to-text", "text-to-image", "image-segmentation",
        "object-detection", "visual-question-answering", "image-text-to-text",
    )),
    (("audio", "text"), (
        "text-to-audio", "text-to-speech", "automatic-speech-recognition",
        "audio-classification",
    )),
    (("text", "video"), ("text-to-video",)),
    (("code", "text"), ("code-generation",)),
)
ARCHITECTURE_NAMES = (
    "transformer", "diffusion", "moe", "mamba", "rwkv", "ssm", "cnn", "gan",
)
KNOWN_MODALITIES = ("text", "image", "audio", "video")
REPO_KEYS = ("Source", "Source Code", "Repository", "GitHub", "Homepage")
SKIPPED_BUNDLES = (
    "com.google.android.googlequicksearchbox", "com.google.android.apps.photos",
    "com.apple.mobilesafari",
)

# Package | product | organisation.
PYPI_PACKAGES = (
    ("transformers", "Transformers", "Hugging Face"),
    ("torch", "PyTorch", "Meta"),
    ("tensorflow", "TensorFlow", "Google"),
    ("langchain", "LangChain", "LangChain"),
    ("openai", "OpenAI Python SDK", "OpenAI"),
    ("anthropic", "Anthropic Python SDK", "Anthropic"),
    ("diffusers", "Diffusers", "Hugging Face"),
    ("datasets", "HuggingFace Datasets", "Hugging Face"),
    ("sentence-transformers", "Sentence Transformers", "Hugging Face"),
    ("gradio", "Gradio", "Hugging Face"),
    ("streamlit", "Streamlit", "Snowflake"),
    ("chromadb", "ChromaDB", "Chroma"),
    ("pinecone-client", "Pinecone", "Pinecone"),
    ("weaviate-client", "Weaviate", "Weaviate"),
    ("qdrant-client", "Qdrant", "Qdrant"),
    ("llama-index", "LlamaIndex", "LlamaIndex"),
    ("vllm", "vLLM", "vLLM"),
    ("mlflow", "MLflow", "Databricks"),
    ("wandb", "Weights & Biases", "Weights & Biases"),
    ("ray", "Ray", "Anyscale"),
    ("ultralytics", "Ultralytics YOLOv8", "Ultralytics"),
    ("keras", "Keras", "Google"),
    ("fastai", "fast.ai", "fast.ai"),
    ("spacy", "spaCy", "Explosion"),
    ("huggingface-hub", "HuggingFace Hub", "Hugging Face"),
)
NPM_PACKAGES = (
    ("openai", "OpenAI Node SDK", "OpenAI"),
    ("@anthropic-ai/sdk", "Anthropic Node SDK", "Anthropic"),
    ("langchain", "LangChain.js", "LangChain"),
    ("@huggingface/inference", "HuggingFace Inference JS", "Hugging Face"),
    ("llamaindex", "LlamaIndex.TS", "LlamaIndex"),
    ("ai", "Vercel AI SDK", "Vercel"),
    ("@tensorflow/tfjs", "TensorFlow.js", "Google"),
    ("onnxruntime-web", "ONNX Runtime Web", "Microsoft"),
    ("replicate", "Replicate Node SDK", "Replicate"),
    ("@pinecone-database/pinecone", "Pinecone Node SDK", "Pinecone"),
    ("chromadb", "ChromaDB JS", "Chroma"),
    ("cohere-ai", "Cohere Node SDK", "Cohere"),
)
DOCKER_IMAGES = (
    ("vllm/vllm-openai", "vLLM", "vLLM"),
    ("ollama/ollama", "Ollama", "Ollama"),
    ("huggingface/text-generation-inference", "TGI", "Hugging Face"),
    ("chromadb/chroma", "ChromaDB", "Chroma"),
    ("qdrant/qdrant", "Qdrant", "Qdrant"),
    ("milvusdb/milvus", "Milvus", "Zilliz"),
    ("weaviate/weaviate", "Weaviate", "Weaviate"),
    ("pytorch/pytorch", "PyTorch", "Meta"),
    ("tensorflow/tensorflow", "TensorFlow", "Google"),
    ("nvidia/tritonserver", "Triton Inference Server", "NVIDIA"),
    ("localai/localai", "LocalAI", "LocalAI"),
)
