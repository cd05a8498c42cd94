"""Hand-written envelopes for the parse tests (FIXTURES.md section 3)."""

import json


def user(uid, username=None, name=None):
    return {"id": uid, "username": username or f"u{uid}", "name": name or f"User {uid}"}


def envelope(pid="1", text="Ein guter Tag.", author="10", source="app", created="2024-03-07T08:15:30.250Z",
             users=None, rules=None, entities=None, attachments=None, extra_data=None, drop=(), **top):
    data = {"id": pid, "text": text, "created_at": created, "author_id": author, "source": source}
    if entities is not None:
        data["entities"] = entities
    if attachments is not None:
        data["attachments"] = attachments
    data.update(extra_data or {})
    for k in drop:
        data.pop(k, None)
    env = {"data": data, "includes": {"users": users if users is not None else [user(author)]},
           "matching_rules": rules if rules is not None else [{"id": 1, "tag": "p1"}]}
    env.update(top)
    return json.dumps(env)

