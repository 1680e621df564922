"""Plain restatements of the rules, to compare results with."""

import math
import re
from collections import Counter, defaultdict

BLANK_BEFORE = set(" \t\n\x0b\f\r")
BLANK_AFTER = BLANK_BEFORE | set("\u0085\u2028\u2029")
RUN_CHARS = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789'-")


def without_urls(text):
    out, i = [], 0
    while i < len(text):
        for scheme in ("https://", "http://", "ftp://"):
            after = i + len(scheme)
            if text.startswith(scheme, i) and after < len(text) and text[after] not in "\t\r\n /$.?#":
                i = after + 1
                while i < len(text) and text[i] not in "\t\r\n ":
                    i += 1
                break
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def words(text):
    found, run = [], ""
    for c in without_urls(text) + "\0":
        if c in RUN_CHARS:
            run += c
        else:
            if any("a" <= x.lower() <= "z" for x in run):
                found.append(run)
            run = ""
    return found


def mask(word):
    return word if len(word) < 3 else word[0] + "*" * (len(word) - 2) + word[-1]


def censor(text, listed):
    return re.sub("[A-Za-z0-9]+", lambda m: mask(m[0]) if m[0].lower() in listed else m[0], text)


def phrase_hits(text, phrase):
    count, at = 0, text.find(phrase)
    while at != -1:
        end = at + len(phrase)
        if (at == 0 or text[at - 1] in BLANK_BEFORE) and (end == len(text) or text[end] in BLANK_AFTER):
            count += 1
        at = text.find(phrase, end)
    return count


def topic_words(posts, stop, n1):
    """``posts``: (post_id, text, impact). Gives (word, posts, score), best first."""
    weight, seen = defaultdict(float), defaultdict(set)
    for post_id, text, impact in posts:
        found = words(text)
        for word, count in Counter(w.lower() for w in found).items():
            if word not in stop:
                weight[word] += count * math.log(impact + 1) / len(found)
                seen[word].add(post_id)
    scores = [(w, len(seen[w]), round(math.log(len(posts) / len(seen[w])) * weight[w], 9)) for w in weight]
    return sorted(scores, key=lambda s: (-s[2], s[0]))[:n1]


def topic_posts(posts, stop, n1, n2):
    top = {w for w, _, _ in topic_words(posts, stop, n1)}
    chosen = [p for p in posts if top & {w.lower() for w in words(p[1])}]
    return sorted(chosen, key=lambda p: (-p[2], -p[0]))[:n2]
