"""Fixed values of the topic taxonomy: its labels, and the patterns that speak for them, which Java reads."""

# Fixed values. They must equal the rules that this library reproduces.
LABELS = (
    "code_algorithm", "code_application", "code_scripting", "code_config",
    "math_derivation", "math_calculation", "math_logic_puzzle",
    "encyclopedia_core", "encyclopedia_qa",
    "academic_textbook", "academic_paper", "professional_report",
    "news_mainstream", "news_commentary",
    "translation_parallel", "linguistics_grammar",
    "article_editorial", "article_blog",
    "literature_classic", "literature_web", "literature_classical",
    "comm_conversational",
    "stem_physics_math", "stem_engineering", "tech_blog_forum",
    "finance_macro", "finance_market", "finance_banking",
    "humanities_history", "humanities_philosophy", "social_psychology",
    "gov_policy", "gov_exam",
    "legal_statute", "legal_case", "medical_guideline", "medical_qa",
    "nsfw", "boiler", "other",
)
BOILER = r"(?i)免责声明|版权(?:所有|声明)|ICP(?:备案)?|Copyright|All\s+Rights\s+Reserved"
NSFW = (
    r"(?i)无码(?:AV片|视频|影片)|AV片|成人视频|成人色情|色情(?:视频|影片|网站|图片|小说)|乱伦(?:视频|影片|色情|小说)|兽交(?:视频|影片|色情)"
    r"|(?:口交|肛交)(?:视频|影片)|性奴(?:调教|视频|影片)|SM调教|\b(?:porn|porno|sex\s+video|hardcore\s+porn)\b"
)
CODE = (
    r"(?i)```|Traceback \(most recent call last\)|\bException\b|\bdef\s+[A-Za-z_][A-Za-z0-9_]*\s*\(|\bclass\s+[A-Za-z_][A-Za-z0-9_]*\b"
    r"|\bfrom\s+[A-Za-z_][A-Za-z0-9_.]*\s+import\s+[A-Za-z_*][A-Za-z0-9_*,\s]*\b|\bimport\s+[A-Za-z_][A-Za-z0-9_.]*\b|\b(?:async\s+def|await\s+|lambda\s+)\b"
    r"|\b(?:public|private|protected|static|void|int|float|double|String)\b|#include\b|using\s+namespace\b|std::|console\.log\b|System\.out\.println\b"
    r"|\b(?:python|java(?:script)?|typescript|c\+\+|rust|golang|c#|sql|bash|powershell|node\.js|react|vue|docker|kubernetes|linux|git)\b"
)
CODE_ALGORITHM = (
    r"(?i)\b(?:leetcode|lintcode|codeforces|atcoder|acm|oj)\b|力扣|题解|算法|复杂度|时间复杂度|空间复杂度|\b(?:O\([^)]+\))\b|动态规划|贪心|二分|并查集"
    r"|线段树|树状数组|最短路|拓扑排序|\b(?:BFS|DFS|DP|Dijkstra|Floyd|KMP|Trie)\b"
)
CODE_SCRIPT = (
    r"(?im)^#!\s*/(?:usr/)?bin/(?:env\s+)?(?:bash|sh|zsh|python)\b|\b(?:chmod|chown|systemctl|journalctl|apt(?:-get)?|yum|dnf|brew|pip|conda|kubectl|docker)\b"
    r"|\b(?:SELECT|INSERT|UPDATE|DELETE|CREATE\s+TABLE|ALTER\s+TABLE|DROP\s+TABLE)\b|\b(?:Get-ChildItem|Set-Location|Write-Output|New-Item|Invoke-WebRequest)\b"
)
MATH = (
    r"(?i)\$[^$\n]{6,}\$|\\\([^\\\n]{6,}\\\)|\\\[[^\\\n]{6,}\\\]|\\(?:frac|sum|int|sqrt|pi|infty|begin|end)\b|[≤≥≈≠∈∉⊂⊆⊇∪∩∑∫√π∞]"
    r"|求解|证明|推导|方程|不等式|积分|导数|微分|极限|矩阵|向量|几何|代数|概率|数列|线性代数|微积分|数学题"
    r"|\b(?:sin|cos|tan|sqrt|log|algebra|geometry|calculus|derivative|integral|matrix|vector|probability|equation)\b"
)
MATH_PROOF = r"(?i)定理|引理|推论|命题|证明|proof|theorem|lemma|corollary|\\begin\{(?:align|equation|gather|proof)\}|\\qed\b"
MATH_PUZZLE = r"(?i)逻辑推理|行测|推理题|智力题|脑筋急转弯|真题|选择题|判断题|甲乙丙丁|下列(?:说法|选项)|正确的是|不正确的是|答案解析|(?:^|\n)\s*[ABCD][.、]\s*"
LEGAL = (
    r"(?i)法律|律师|合同|法院|判决|起诉|诉讼|刑法|民法|劳动法|条款|证据|法规|合规|侵权|知识产权|著作权|商标|专利|法典|司法"
    r"|\b(?:contract|lawsuit|court|legal|law|attorney|copyright|patent)\b"
)
LEGAL_STATUTE = (
    r"(?i)中华人民共和国|本法|条例|实施细则|司法解释|附则|第[一二三四五六七八九十百千0-9]{1,6}条|第[一二三四五六七八九十百千0-9]{1,6}章|《[^》]{2,40}(?:法|条例|规定)》"
)
LEGAL_CASE = (
    r"(?i)判决书|裁定书|调解书|本院认为|本案|案号|审理|原告|被告|上诉人|被上诉人|诉讼请求|事实与理由|辩称|代理人|二审|一审|再审"
)
MEDICAL = (
    r"(?i)症状|用药|剂量|诊断|处方|药物|发烧|咳嗽|血压|糖尿病|高血压|感染|肿瘤|疼痛|过敏|急诊|体温|临床|疗效|不良反应|治疗方案"
    r"|\b(?:symptom|diagnos|dose|medicine|hospital|doctor|clinical|guideline)\b"
)
MEDICAL_GUIDELINE = (
    r"(?i)指南|共识|诊疗(?:规范|指南|路径)?|推荐(?:意见|等级)?|循证|证据等级|适应证|禁忌证|用法用量|不良反应|注意事项|临床试验|随机对照"
    r"|\b(?:ICD-?10|RCT|meta-?analysis)\b"
)
MEDICAL_QA = r"(?i)医生(?:您好|好)|请问|我(?:该|应该)怎么办|可以(?:吃|用)什么药|有没有(?:关系|问题)|多久能好|需要(?:检查|就医)吗|是不是|严重吗"
MACRO = (
    r"(?i)\b(?:GDP|CPI|PPI|PMI|M2|LPR|FOMC|FED)\b|宏观|通胀|通货膨胀|货币政策|财政政策|降准|加息|降息|央行|美联储|经济增长|失业率|汇率|外汇|国债收益率|利差|贸易顺差|赤字"
)
RATE = r"利率|收益率"
RATE_CONTEXT = r"(?i)央行|美联储|货币政策|LPR|降准|加息|降息|国债"
MARKET = (
    r"(?i)研报|证券|股票|股价|市值|估值|PE\b|PB\b|EPS\b|ROE\b|财报|业绩|净利润|营收|现金流|投资建议|目标价|风险提示|机构观点|基金|债券|期货|行情"
)
BANK = r"银行(?:业)?|存款|贷款|利息|理财|信用卡|征信|房贷|按揭|授信|风控|不良贷款|资产负债表|净息差|资本充足率"
EXAM = r"公务员(?:考试)?|国考|省考|事业单位|申论|行测|面试真题|备考|答案解析|范文|材料作文"
POLICY = (
    r"国务院|中央(?:委员会)?|人民政府|政府工作报告|白皮书|发改委|工业和信息化部|工信部|教育部|财政部|民政部|商务部|人民银行|央行|证监会|银保监会"
    r"|关于[^\n]{0,60}(?:通知|意见|决定|公告|实施方案|工作要点|规划|纲要)"
)
PHYSICS = (
    r"(?i)量子|相对论|薛定谔|玻色|费米|标准模型|弦论|暗物质|暗能量|宇宙学|粒子物理|凝聚态|热力学|电动力学|场论|拉格朗日|哈密顿量"
    r"|\b(?:quantum|relativity|cosmology|particle\s+physics|thermodynamics|electrodynamics)\b"
)
ENGINEERING = r"(?i)GB/T|ISO|IEC|JIS|ASTM|机械(?:工程)?|电气(?:工程)?|航天|航空|发动机|涡轮|材料力学|结构力学|电路|控制(?:系统)?|PLC"
TECH_FORUM = (
    r"(?i)\b(?:stack\s*overflow|stackexchange|hacker\s*news|news\.ycombinator|v2ex|reddit)\b|论坛|社区|帖子|楼主|回复|评论区|置顶|更新日志|issue\s*#|pull\s+request"
)
HISTORY = r"朝代|皇帝|年号|史记|资治通鉴|编年史|传记|王朝|公元前|公元|年代|考古|战争|起义|革命"
PHILOSOPHY = (
    r"(?i)哲学|形而上学|认识论|伦理学|道德哲学|存在主义|现象学|逻辑学|康德|黑格尔|尼采|柏拉图|亚里士多德|维特根斯坦|\b(?:philosophy|ethics|metaphysics|epistemology)\b"
)
PSYCHOLOGY = (
    r"(?i)心理学|社会学|人格|认知|行为|情绪|抑郁|焦虑|实验|问卷|样本|量表|统计显著|相关性|回归分析|\b(?:psychology|sociology|cognitive|behavioral)\b"
)
GRAMMAR = r"(?i)词性|音标|释义|例句|语法|时态|从句|主谓|宾语|\b(?:pronunciation|grammar|tense|clause|synonym|antonym)\b"
WIKI = r"(?im)维基百科|Wikipedia|wiki|(?:^|\n)\s*(?:参考文献|外部链接|参见|目录)\s*[:：]?\s*$|Category:|分类:"
QA_MARK = r"(?i)(?:^|\n)\s*(?:问|Q)[:：]|(?:^|\n)\s*(?:答|A)[:：]"
PAPER = (
    r"(?im)\bAbstract\b|\bIntroduction\b|\bMethod(?:s)?\b|\bResults\b|\bDiscussion\b|\bConclusion\b|\bReferences\b|doi\s*:\s*|arXiv\s*:\s*|ISSN|et\s+al\."
    r"|(?:^|\n)\s*(?:摘要|关键词|引言|参考文献)\s*[:：]"
)
TEXTBOOK = r"第[一二三四五六七八九十百千0-9]{1,6}章|本章(?:小结|要点)?|学习目标|例题|习题|课后(?:练习|习题)|思考题|知识点|教学"
REPORT = r"研究报告|行业研究|深度报告|白皮书|风险提示|投资建议|数据来源|图表目录|报告摘要|核心观点|免责声明"
NEWS = r"(?i)新华社|人民网|央视|中新网|记者|报道|讯|日电|\b(?:reuters|ap\s+news|bloomberg)\b|\b[0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日\b"
COMMENTARY = r"时评|社论|评论员|评论|观点|我们认为|笔者认为|专栏|解读"
EDITORIAL = r"(?i)编者按|本刊|专栏|特约(?:撰稿|评论)|长文|深度|观点|\b(?:editorial|opinion|column)\b"
BLOG = r"(?i)博客|公众号|本文|作者|发表于|更新于|转载|阅读原文|原创|个人观点|\b(?:blog|medium\.com|substack)\b"
