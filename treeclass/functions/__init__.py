from treeclass.functions.text import (  # noqa: F401
    DROPPED_TAGS, lemma_base, tag_is_dropped, tokenize,
)
from treeclass.functions.hashing import md5_bucket, md5_hash, murmur_bucket, bucket  # noqa: F401
from treeclass.functions.scoring import sigmoid  # noqa: F401
