"""Patterns and word lists that fix what counts as a citation, a number, an identifier or a label."""

# Citation grammars. Local ones name a slide and an element, qualified ones a source as well.
LOCAL_CITATION = r"\[slide-(\d+)#([^\]\s#]+)\]"
QUALIFIED_CITATION = r"\[@([a-z0-9](?:[a-z0-9._-]{0,126}[a-z0-9])?)/slide-(\d+)#([^\]\s#]+)\]"

# Number grammars. Prose numbers may not follow a digit; claim and raw numbers may not touch letters or digits;
# raw numbers keep their spelling and know per mille.
PROSE_NUMBER = r"(?<!\d)[-+]?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?(?:[%％])?"
CLAIM_NUMBER = r"(?<![0-9A-Za-z])[-+]?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?%?(?![0-9A-Za-z])"
RAW_NUMBER = r"(?<![0-9A-Za-z])[+-]?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?(?:%|‰)?(?![0-9A-Za-z])"

# Identifiers, and request numbers with their labels (English and Korean).
IDENTIFIER = r"(?i)(?<![A-Z0-9])(?:[A-Z]{2,8}[ \t_-]+[A-Z0-9][A-Z0-9._/\-]{0,63})(?![A-Z0-9])"
REQUEST_LABEL = r"(?:PR[ \t]*(?:번호|NO\.?|NUMBER|#)|의뢰[ \t]*번호)"
REQUEST_VALUE = r"(?:PR[ \t_-]*)?[A-Z0-9][A-Z0-9._/\-]{0,63}"
REQUEST_PREFIXED = r"PR[ \t_-]+(?:[A-Z]+[ \t_-]+)?\d[A-Z0-9._/\-]{0,63}"
REQUEST_LIKE = r"[A-Z]{2,6}[ \t_-]+[A-Z0-9][A-Z0-9._/\-]{0,63}"

# Markup that generated pages may not hold.
MARKDOWN_IMAGE = r"(?<!\\)!\[(?:\\.|[^\]])*\](?:\([^\n)]*\)|\[[^\]\n]*\])"
HTML_IMAGE = r"(?i)<\s*/?\s*(?:img|picture|source|svg)\b"
DANGEROUS_HTML = r"(?i)<\s*/?\s*(?:script|iframe|object|embed)\b|\son[a-z]+\s*=|javascript:"

# Vocabularies of the knowledge graph.
VISUAL_KINDS = ("image", "picture", "chart", "diagram", "media", "ole")
SAFE_ID = r"^[a-z0-9](?:[a-z0-9._-]{0,126}[a-z0-9])?$"
RESERVED_STEMS = ("con", "prn", "aux", "nul")
