"""Word lists of keyword extraction and job-keyword matching."""

# English stop words.
STOP_WORDS = tuple("""
the a an is are was were be been and or but in on at to for of with by from as into through
during before after it its this that these those i we you he she they me him her us them my
your his our their what which who when where how not no can will just should now also than
then very more most such each every all any has have had do does did
""".split())

# Short terms kept regardless of length.
PRESERVED_TERMS = tuple("""
ai ml llm nlp gpt gpu tpu npu rag api sdk cli saas b2b b2c
""".split())

WORD_PATTERN = r"[A-Za-z][A-Za-z0-9-]+"
HAN_RUN_PATTERN = r"[一-鿿]{2,}"
MAX_WORDS = 20
MAX_HAN_RUNS = 15

# Job keyword configuration (language -> search / match / categories).
JOB_KEYWORDS = {
    "en": {
        "search": [
            "Machine Learning Engineer", "AI Researcher", "Deep Learning Engineer",
            "NLP Engineer", "LLM Engineer", "Computer Vision Engineer",
            "Generative AI Engineer", "MLOps Engineer", "Robotics Engineer",
            "AI Research Scientist", "Prompt Engineer", "Autonomous Systems Engineer",
            "AI Software Engineer", "Data Scientist Machine Learning",
        ],
        "match": [
            "machine learning", "artificial intelligence", "deep learning",
            "natural language processing", "nlp", "llm", "large language model",
            "computer vision", "neural network", "generative ai", "autonomous", "robotics",
            "mlops", "reinforcement learning", "transformer", "diffusion model",
            "speech recognition", "text to speech", "ai research", "prompt engineer",
        ],
        "categories": {
            "llm-foundation-model": ["llm", "large language model", "gpt", "transformer", "foundation model", "language model"],
            "ai-coding": ["ai coding", "code generation", "copilot", "code assistant"],
            "ai-image-video": ["computer vision", "image generation", "video generation", "diffusion model", "stable diffusion", "image recognition"],
            "ai-audio-speech": ["speech recognition", "text to speech", "voice ai", "audio", "asr", "tts"],
            "ai-search": ["semantic search", "information retrieval", "search ai", "vector search"],
            "ai-robotics": ["robotics", "autonomous vehicle", "self-driving", "robot", "drone"],
            "ai-infrastructure": ["mlops", "ml platform", "ai infrastructure", "model serving", "feature store"],
            "ai-data-analytics": ["data science", "analytics", "data engineering", "data pipeline"],
            "ai-assistant": ["ai assistant", "chatbot", "conversational ai", "virtual assistant"],
            "ai-healthcare": ["medical ai", "healthcare ai", "biomedical", "drug discovery"],
            "ai-security-defense": ["ai security", "threat detection", "cybersecurity ai"],
            "ai-finance": ["fintech ai", "trading ai", "financial ai", "risk model"],
        },
    },
    "zh": {
        "search": [
            "AI工程师", "人工智能工程师", "算法工程师", "机器学习工程师", "深度学习工程师",
            "大模型工程师", "LLM工程师", "人工智能研究员", "AI研究员", "NLP工程师",
            "自然语言处理", "计算机视觉工程师", "语音识别工程师", "AIGC工程师", "智能体开发",
            "AI Agent", "多模态", "具身智能", "MLOps", "AI平台工程师", "推理优化",
            "自动驾驶算法", "自动驾驶工程师", "AI芯片", "机器人算法", "AI安全", "强化学习",
        ],
        "match": [
            "机器学习", "人工智能", "深度学习", "算法", "大模型", "自然语言处理",
            "计算机视觉", "自动驾驶", "神经网络", "强化学习", "语音识别", "图像识别",
            "生成式ai", "aigc", "智能驾驶", "机器人", "智能体", "多模态", "具身智能",
            "推理优化", "ai芯片", "ai agent",
        ],
        "categories": {
            "llm-foundation-model": ["大模型", "语言模型", "gpt", "大语言模型", "llm"],
            "ai-image-video": ["计算机视觉", "图像", "视频", "图像识别", "图像生成", "视频生成"],
            "ai-audio-speech": ["语音识别", "语音合成", "语音"],
            "ai-robotics": ["机器人", "自动驾驶", "智能驾驶", "无人机", "具身智能"],
            "autonomous-vehicles": ["自动驾驶", "智能驾驶", "无人驾驶"],
            "ai-infrastructure": ["算法平台", "模型部署", "训练平台", "mlops", "推理优化", "ai芯片"],
        },
    },
}

# The smaller configuration used when no keyword file is given.
DEFAULT_JOB_KEYWORDS = {
    "en": {
        "search": [
            "Machine Learning Engineer", "AI Researcher", "Deep Learning Engineer",
            "NLP Engineer", "LLM Engineer", "Computer Vision Engineer", "Generative AI Engineer",
        ],
        "match": [
            "machine learning", "artificial intelligence", "deep learning", "nlp", "llm",
            "computer vision", "neural network", "generative ai", "autonomous", "robotics",
        ],
        "categories": {
            "llm-foundation-model": ["llm", "large language model", "gpt"],
            "ai-robotics": ["robotics", "autonomous", "self-driving"],
            "ai-image-video": ["computer vision", "image generation", "diffusion"],
        },
    },
    "zh": {
        "search": [
            "AI工程师", "人工智能工程师", "算法工程师", "机器学习工程师", "深度学习工程师",
            "大模型工程师", "LLM工程师", "人工智能研究员", "NLP工程师", "自然语言处理",
            "计算机视觉工程师", "语音识别工程师", "AIGC", "智能体开发", "AI Agent", "多模态",
            "具身智能", "MLOps", "AI平台工程师", "推理优化", "自动驾驶算法", "AI芯片",
            "机器人算法", "AI安全",
        ],
        "match": [
            "机器学习", "人工智能", "深度学习", "算法", "大模型", "自然语言处理", "计算机视觉",
            "语音识别", "aigc", "智能体", "多模态", "具身智能", "自动驾驶", "推理优化",
        ],
        "categories": {
            "llm-foundation-model": ["大模型", "语言模型", "llm"],
            "ai-robotics": ["机器人", "自动驾驶", "具身智能"],
            "ai-image-video": ["计算机视觉", "图像生成", "视频生成"],
            "ai-infrastructure": ["mlops", "推理优化", "ai平台", "ai芯片"],
        },
    },
}
