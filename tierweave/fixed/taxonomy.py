"""Category, tag and enum vocabularies."""

# Category id, English name, Chinese name, icon.
CATEGORIES = (
    ("ai-foundation-model", "AI Foundation Model", "AI 基础模型", "brain"),
    ("ai-application", "AI Application", "AI 应用", "app-window"),
    ("ai-creative-media", "AI Creative & Media", "AI 创意与媒体", "palette"),
    ("ai-dev-platform", "AI Dev Platform", "AI 开发平台", "code"),
    ("ai-infrastructure", "AI Infrastructure", "AI 基础设施", "server"),
    ("ai-data-platform", "AI Data Platform", "AI 数据平台", "database"),
    ("ai-search-retrieval", "AI Search & Retrieval", "AI 搜索与检索", "search"),
    ("ai-hardware", "AI Hardware & Robotics", "AI 硬件与机器人", "cpu"),
    ("ai-security-governance", "AI Security & Governance", "AI 安全与治理", "shield"),
    ("ai-science-research", "AI for Science", "AI 科学研究", "flask-conical"),
    ("ai-enterprise-vertical", "AI Enterprise Vertical", "AI 行业垂直", "building"),
)
CATEGORY_IDS = tuple(c[0] for c in CATEGORIES)

# Older category id -> current id, as still sent by sources.
CATEGORY_ALIASES = {
    "ai-model": "ai-foundation-model",
    "ai-app": "ai-application",
    "ai-agent": "ai-application",
    "ai-dev-tool": "ai-dev-platform",
    "ai-data": "ai-data-platform",
    "ai-search": "ai-search-retrieval",
    "ai-security": "ai-security-governance",
    "ai-science": "ai-science-research",
}

# Closed value sets of the product schema.
PRODUCT_TYPES = (
    "llm", "app", "dev-tool", "hardware", "dataset", "framework", "api-service", "other",
)
STATUSES = ("active", "beta", "alpha", "announced", "deprecated", "discontinued")
PRICING_MODELS = ("free", "freemium", "paid", "enterprise", "open-source", "usage-based")

# The vocabulary as (dimension, tag_id, name, name_zh).
TAGS = (
    ("technology", "transformer", "Transformer", "Transformer 架构"),
    ("technology", "diffusion-model", "Diffusion Model", "扩散模型"),
    ("technology", "rag", "RAG", "检索增强生成"),
    ("technology", "multimodal", "Multimodal", "多模态"),
    ("technology", "nlp", "NLP", "自然语言处理"),
    ("technology", "computer-vision", "Computer Vision", "计算机视觉"),
    ("technology", "reinforcement-learning", "Reinforcement Learning", "强化学习"),
    ("technology", "fine-tuning", "Fine-tuning", "模型微调"),
    ("technology", "embedding", "Embedding", "向量嵌入"),
    ("technology", "speech-to-text", "Speech to Text", "语音转文字"),
    ("technology", "text-to-image", "Text to Image", "文生图"),
    ("technology", "text-to-video", "Text to Video", "文生视频"),
    ("technology", "text-to-speech", "Text to Speech", "文字转语音"),
    ("technology", "text-to-3d", "Text to 3D", "文生3D"),
    ("technology", "text-to-music", "Text to Music", "文生音乐"),
    ("technology", "code-generation", "Code Generation", "代码生成"),
    ("technology", "prompt-engineering", "Prompt Engineering", "提示工程"),
    ("technology", "image-to-video", "Image to Video", "图生视频"),
    ("technology", "graph-neural-network", "Graph Neural Network", "图神经网络"),
    ("technology", "neuro-symbolic", "Neuro-Symbolic", "神经符号"),
    ("technology", "moe", "Mixture of Experts", "混合专家"),
    ("technology", "quantization", "Quantization", "量化"),
    ("technology", "distillation", "Distillation", "蒸馏"),
    ("technology", "federated-learning", "Federated Learning", "联邦学习"),
    ("use_case", "chatbot", "Chatbot", "聊天机器人"),
    ("use_case", "copilot", "Copilot", "编程助手"),
    ("use_case", "writing-assistant", "Writing Assistant", "写作助手"),
    ("use_case", "data-analysis", "Data Analysis", "数据分析"),
    ("use_case", "content-creation", "Content Creation", "内容创作"),
    ("use_case", "customer-support", "Customer Support", "客户服务"),
    ("use_case", "search-engine", "Search Engine", "搜索引擎"),
    ("use_case", "workflow-automation", "Workflow Automation", "工作流自动化"),
    ("use_case", "marketing", "Marketing", "营销"),
    ("use_case", "translation", "Translation", "翻译"),
    ("use_case", "meeting-notes", "Meeting Notes", "会议纪要"),
    ("use_case", "design-creative", "Design & Creative", "设计创意"),
    ("use_case", "photo-editing", "Photo Editing", "图片编辑"),
    ("use_case", "video-editing", "Video Editing", "视频编辑"),
    ("use_case", "voice-assistant", "Voice Assistant", "语音助手"),
    ("use_case", "personal-assistant", "Personal Assistant", "个人助手"),
    ("use_case", "knowledge-base", "Knowledge Base", "知识库"),
    ("use_case", "research", "Research", "研究"),
    ("use_case", "testing-qa", "Testing & QA", "测试与质量保证"),
    ("use_case", "code-review", "Code Review", "代码审查"),
    ("use_case", "presentation", "Presentation", "演示文稿"),
    ("use_case", "email", "Email", "邮件"),
    ("use_case", "sales-crm", "Sales & CRM", "销售与CRM"),
    ("use_case", "hr-recruiting", "HR & Recruiting", "人力资源与招聘"),
    ("use_case", "project-management", "Project Management", "项目管理"),
    ("use_case", "content-moderation", "Content Moderation", "内容审核"),
    ("use_case", "social-media", "Social Media", "社交媒体"),
    ("use_case", "legal-assist", "Legal Assist", "法律辅助"),
    ("use_case", "finance-accounting", "Finance & Accounting", "财务会计"),
    ("use_case", "education-tutoring", "Education & Tutoring", "教育辅导"),
    ("domain", "healthcare", "Healthcare", "医疗健康"),
    ("domain", "drug-discovery", "Drug Discovery", "药物发现"),
    ("domain", "medical-imaging", "Medical Imaging", "医学影像"),
    ("domain", "protein-folding", "Protein Folding", "蛋白质折叠"),
    ("domain", "finance", "Finance", "金融"),
    ("domain", "trading", "Trading", "交易"),
    ("domain", "risk-assessment", "Risk Assessment", "风险评估"),
    ("domain", "fraud-detection", "Fraud Detection", "欺诈检测"),
    ("domain", "legal", "Legal", "法律"),
    ("domain", "education", "Education", "教育"),
    ("domain", "gaming", "Gaming", "游戏"),
    ("domain", "defense", "Defense", "国防"),
    ("domain", "climate-energy", "Climate & Energy", "气候与能源"),
    ("domain", "materials-science", "Materials Science", "材料科学"),
    ("domain", "clinical-trials", "Clinical Trials", "临床试验"),
    ("domain", "autonomous-vehicles", "Autonomous Vehicles", "自动驾驶"),
    ("domain", "robotics", "Robotics", "机器人"),
    ("domain", "self-driving", "Self-Driving", "无人驾驶"),
    ("domain", "humanoid-robot", "Humanoid Robot", "人形机器人"),
    ("domain", "drone", "Drone", "无人机"),
    ("business_model", "open-source", "Open Source", "开源"),
    ("business_model", "api-service", "API Service", "API 服务"),
    ("business_model", "saas", "SaaS", "SaaS 云服务"),
    ("business_model", "freemium", "Freemium", "免费增值"),
    ("business_model", "usage-based", "Usage Based", "按量计费"),
    ("business_model", "enterprise", "Enterprise", "企业版"),
    ("business_model", "self-hosted", "Self-Hosted", "私有部署"),
    ("business_model", "cloud-native", "Cloud Native", "云原生"),
    ("business_model", "closed-source", "Closed Source", "闭源"),
    ("business_model", "b2b", "B2B", "面向企业"),
    ("business_model", "b2c", "B2C", "面向消费者"),
    ("audience", "developers", "Developers", "开发者"),
    ("audience", "data-scientists", "Data Scientists", "数据科学家"),
    ("audience", "enterprises", "Enterprises", "企业用户"),
    ("audience", "consumers", "Consumers", "普通用户"),
    ("audience", "researchers", "Researchers", "研究人员"),
    ("audience", "creators", "Creators", "创作者"),
    ("audience", "marketers", "Marketers", "营销人员"),
    ("audience", "students", "Students", "学生"),
    ("technical", "real-time", "Real-time", "实时"),
    ("technical", "low-latency", "Low Latency", "低延迟"),
    ("technical", "high-throughput", "High Throughput", "高吞吐"),
    ("technical", "on-device", "On-Device", "端侧运行"),
    ("technical", "edge-ai", "Edge AI", "边缘AI"),
    ("technical", "mobile-app", "Mobile App", "移动应用"),
    ("technical", "desktop-app", "Desktop App", "桌面应用"),
    ("technical", "browser-extension", "Browser Extension", "浏览器扩展"),
    ("technical", "api-platform", "API Platform", "API 平台"),
    ("technical", "sdk", "SDK", "开发套件"),
    ("technical", "cli-tool", "CLI Tool", "命令行工具"),
    ("special", "unicorn", "Unicorn", "独角兽"),
    ("special", "decacorn", "Decacorn", "超级独角兽"),
    ("special", "yc-backed", "YC-Backed", "YC 孵化"),
    ("special", "china", "China", "中国"),
    ("special", "us", "United States", "美国"),
    ("special", "europe", "Europe", "欧洲"),
    ("special", "japan", "Japan", "日本"),
    ("special", "korea", "Korea", "韩国"),
    ("special", "trending", "Trending", "热门"),
    ("special", "newly-launched", "Newly Launched", "新上线"),
)
TAG_IDS = tuple(t[1] for t in TAGS)

#: Most tags one product may carry.
MAX_TAGS = 20
