"""Fixed values of the text rules, as regular expressions that Java and RE2 both read."""

# Fixed values. They must equal the rules that this library reproduces.
CJK = r"[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}]"
LATIN = r"[A-Za-z]"
URL = r"(?i)https?://|www\."
TAG = r"</?[A-Za-z][^>]{0,200}>"
OCR_LINE = r"^\s*[0-9]{1,4}\s*[、.)．]\s*"
FOOTER = r"(?i)(?:订阅|手机报|免责声明|版权所有|备案号|ICP备|联系我们|扫码关注|all rights reserved|privacy policy|cookie policy)"
SENTENCE_END = r"[。！？；!?;]+|(?<![0-9])\.(?:\s+|$)|\n+"
YEAR = r"^(19[0-9]{2}|20[0-9]{2}|2100)(?:[-T]|$)"
VENDOR_PATH = r"(?i)(?:^|/)(?:node_modules|bower_components|vendor|third[_-]?party|site-packages|dist|build)(?:/|$)"
GENERATED = r"(?i)\b(?:auto[- ]?generated|generated by|do not edit|machine generated)\b"
PROPRIETARY = r"(?i)\b(?:unpublished proprietary|commercial license|confidential information|unauthorized copying)\b"
SECRETS = (
    r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\b",
)
BASE64_BLOB = r"[A-Za-z0-9+/]{1000,}={0,2}"
HUMAN_BOT = r"(?i)<\s*/?\s*(human|bot)\b"
AI_MENTION = r"(?i)(?:作为|身为|我是).{0,24}?(?:AI|人工智能|大语言模型|语言模型|智能助手)|\b(?:i\s*(?:am|'m)|as\s+an?)\s+(?:ai|artificial\s+intelligence|llm|(?:large\s+)?language\s+model)\b"
PLACEHOLDER = r"(?i)TODO|TBA|<\.\.\.>|<\s*\.\.\.\s*>|\[\.\.\.\]|\{\.{3}\}"
THINK_BLOCK = r"(?is)<\s*think\s*>.*?<\s*/\s*think\s*>"
THINK_TAG = r"(?i)<\s*/?\s*think\s*>"
EMOJI = r"[\x{1F1E6}-\x{1F1FF}\x{1F300}-\x{1FAFF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}\x{FE00}-\x{FE0F}]"
NUMBER_RUN = r"[0-9]+|[零一二三四五六七八九十百千万两]+"
CODE_FENCE = r"(?s)```[a-zA-Z0-9_+-]*\n.*?```"
NUMERAL = r"[0-9]|[一二三四五六七八九十百千万零两]"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
ESSAY_MILL = (
    r"(?is)get\s+professional\s+assignment\s+help|professional\s+assignment\s+help\s+cheaply|assignment\s+help\s+service"
    r"|online\s+(?:\w+\s+){0,3}homework\s+help\s+service|(?:essay|paper|academic)\s+writing\s+service|write\s+my\s+(?:essay|paper)"
    r"|do\s+my\s+(?:homework|assignment)|buy\s+(?:an?\s+)?(?:essay|paper)|our\s+(?:team\s+of\s+)?professional\s+academic\s+writers"
    r"|hire\s+(?:one\s+of\s+)?(?:our\s+)?(?:expert|academic)\s+writers"
)
DATE_TITLE = r"(?im)^#{0,3}\s*what\s+(?:is\s+the\s+date|date\s+(?:is|will\s+it\s+be))\s+[0-9]+\s+days?\s+(?:from|after)\b"
DATE_BODY = r"(?i)adding\s+[0-9]+\s+days?\s+from\s+.{3,80}\s+is\s+.{3,80}"
DATE_HAND = r"(?i)calculating\s+[0-9]+\s+days?\s+from\s+.{3,80}\s+by\s+hand"
PAYWALL = (
    r"(?is)subscribe\s+to\s+view\s+the\s+full\s+document|start\s+(?:your|a)\s+48-hour\s+(?:free|complimentary)\s+trial\s+to\s+unlock\s+this\s+answer"
    r"|become\s+a\s+study\.com\s+member\s+to\s+unlock\s+this\s+answer|unlock\s+the\s+solution\s+to\s+this\s+question"
)
EMPTY_ANSWER = r"(?im)^\s*(?:#{1,6}\s*)?answer\s*:\s*(?=(?:\n\s*(?:#{1,6}\s*)?question\b)|\Z)"
# Signs of audit flags.
AUDIT_URL = r"(?i)https?://[^\s]+|www\.[^\s]+"
AUDIT_TAG = (
    r"(?i)<\s*/?\s*(?:html|head|body|meta|link|title|style|script|noscript|div|span|p|br|hr|img|a|table|tr|td|th|thead|tbody|ul|ol|li|h1|h2|h3|h4|h5|h6"
    r"|form|input|textarea|button|select|option|iframe)\b"
)
AUDIT_ENTITY = r"(?i)&(?:nbsp|amp|lt|gt|quot|apos|#[0-9]+);"
AUDIT_CODE = r"(?m)```|^\s*(?:def\s+\w+|class\s+\w+|import\s+\w+|from\s+\w[\w.]*\s+import\s+\w+|#include\s+[<\"]|package\s+\w+|func\s+\w+)"
AUDIT_CONTACT = r"公众号|公号|微信群|QQ群|群号|加群|进群|入群|客服微信|联系客服|联系我们|商务合作|广告合作|投稿邮箱|(?:微信号|VX|Vx|vx)\s*[:：]\s*[A-Za-z0-9][A-Za-z0-9_-]{3,}"
AUDIT_NAV = r"上一章|下一章|上一页|下一页|返回目录|章节目录|目录页|最新章节|全文阅读|手机阅读|加入书签|加入收藏|书架|书柜|投票|推荐票|月票|打赏|返回顶部"
AUDIT_FOOTER = r"(?i)免责声明|版权声明|版权所有|版权归|转载请注明|转载来源|原文链接|未经授权|不得转载|Copyright|All rights reserved|ICP\s*\S{4,}|ICP备\s*\S{4,}|公安(?:网安)?备案"
AUDIT_DOWNLOAD = r"(?i)(?:点击|立即|免费)?\s*(?:下载|安装)[^\n]{0,24}(?:APP|客户端|软件|阅读器|手机版|官方)"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~，。！？；：、（）【】《》“”‘’—…·「」『』～"
# Signs of structure.
DOCKERFILE = r"(?im)^\s*(FROM|RUN|CMD|COPY|ADD|ENV|WORKDIR|ENTRYPOINT|EXPOSE|ARG|LABEL)\b"
XML_DECLARATION = r"(?i)<\?xml\b"
JSON_KEY = r'"[^"]{1,64}"\s*:\s*'
YAML_LINE = r"(?m)^\s*[A-Za-z0-9_.-]{1,64}\s*:\s*[^:\n]{0,200}$"
INI_SECTION = r"(?m)^\s*\[[^\]\n]{1,80}\]\s*$"
INI_LINE = r"(?m)^\s*[A-Za-z0-9_.-]{1,64}\s*=\s*[^=\n]{0,200}$"
HTML_TAG = r"</?[a-zA-Z][a-zA-Z0-9:_-]*(\s+[^<>]{0,200})?>"
TRANSLATION = r"(?i)翻译|译文|原文|中译英|英译中|译为|译成|translate|translation|interpret"
PARALLEL = r"(?i)原文[:：].{0,30}\n.{0,10}(?:译文|翻译)[:：]|(?:^|\n)\s*(?:中文|英文|Chinese|English)\s*[:：]"
HAN = r"[\x{4e00}-\x{9fff}]"
CLASSICAL = r"之乎者也|焉|矣|吾|汝|其|乃|遂|然也|者也"
CHAPTER_ZH = r"第[一二三四五六七八九十百千0-9]{1,6}[章节回卷]"
CHAPTER_EN = r"(?i)\b(?:chapter|book|part)\b\s+(?:[0-9]{1,4}|[ivxlcdm]{1,8})\b|\b(?:act|scene)\b\s+(?:[0-9]{1,4}|[ivxlcdm]{1,8})\b"
WEB_NOVEL = r"(?i)作者有话说|求收藏|求推荐|打赏|月票|VIP|订阅|晋江|起点|纵横|番茄小说|更新|完结感言|上架感言"
DIALOGUE = r"(?i)“|”|「|」|『|』|说道|问道|答道|笑道|低声|沉默|喊道|\b(?:said|asked|replied|whispered|murmured|shouted|yelled|cried)\b"
FORUM = r"(?im)楼主|回复|评论|点赞|哈哈|233|吃瓜|围观|顶|沙发|板凳|@[\w\x{4e00}-\x{9fff}]{1,16}|(?:^|\n)\s*>\s*"
# Prompts that close a talk, and ones that ask.
CLOSING = r"谢谢|多谢|感谢|好的|好嘞|明白了|懂了|晚安|睡了|再见|拜拜|辛苦了|收到|行吧|就这样|没问题了|我去试试|太好了|不错|嗯嗯|哈哈"
ASKING = r"[?？]|为什么|怎么|如何|什么是|是什么|解释|说明|介绍|推荐|帮我|写一|给我|能不能|可不可以|怎样|哪些|区别|原理|办法|建议"
# Marks of generated data in code files.
BLOB_QUICKJS = ("File generated automatically by the QuickJS compiler",)
BLOB_BASE64 = ("base64.b64decode(",)
BLOB_SOURCEMAP = ("sourceMappingURL=data:",)
BLOB_FONT = ("data:font/",)
BLOB_BUNDLE = ("webpackJsonp", "__webpack_require__", "Minified React error")
BLOB_BUNDLE_START = ("var react_", "(window.webpackJsonp")
BLOB_WASM = ("_scriptDir", "WebAssembly", "wasm")
BLOB_LITERAL = ("tagInfoJSON", "TRANSACTION_HISTORY_EXTENSION")
BLOB_NUMBERS = ("raw_data[]", "ModelData[]", "static const unsigned short raw_data")
