"""Deterministic stand-ins for a model; shipped to the workers."""

import json
import os
import time
import uuid

from lectern.operators import calls as ca


class Upper:
    def generate(self, model, prompt, temperature):
        return ca.Reply(prompt.upper() + " ", 1, None)


class Never:
    def generate(self, model, prompt, temperature):
        raise AssertionError("must not be called")


class Refusing:
    def generate(self, model, prompt, temperature):
        if "bad" in prompt:
            raise ValueError("refused")
        return ca.Reply(prompt.upper())


class Chatty:
    """First answer unusable, repaired on request; one run never answers well."""

    def generate(self, model, prompt, temperature):
        if "hopeless" in prompt:
            return ca.Reply("bad")
        if not prompt.startswith("Fix"):
            return ca.Reply("not json")
        return ca.Reply('[{"span_id": 1, "action": "REMOVE", "label": "SEATING", "reason": "asks for a seat"}]')


class Condenser:
    def generate(self, model, prompt, temperature):
        if prompt.startswith("R"):
            blocks = json.loads(prompt[1:])
            return ca.Reply("\n\n".join(f"## Block {i:02d}: {b['title']}\n{b['body']}" for i, b in enumerate(blocks, 1)))
        rows = [(1, 3, "Harbour", "Ships leave at dawn."), (4, 8, "The long crossing", "Wind from the west.")]
        rows = rows if "[1]" in prompt else [(8, 9, "Landfall", "An island.")]
        keys = ("from_paragraph", "to_paragraph", "title", "body")
        return ca.Reply(json.dumps({"blocks": [dict(zip(keys, r)) for r in rows]}))


class Broken:
    def generate(self, model, prompt, temperature):
        return ca.Reply("{}" if prompt.startswith("M[1] fine") else "" if prompt.startswith("R") else "nonsense")


class Staged:
    """Answers by the first word of the prompt, one behaviour per stage."""

    def generate(self, model, prompt, temperature):
        kind, _, text = prompt.partition(":")
        if kind == "classify":
            rows = [{"span_id": int(line[1:line.index("]")]), "action": "REMOVE" if "chatter" in line else "KEEP"}
                    for line in text.splitlines() if line.startswith("[")]
            return ca.Reply(json.dumps(rows), 10, 5)
        if kind == "map":
            lines = [line for line in text.splitlines() if line.startswith("[")]
            blocks = [{"from_paragraph": i, "to_paragraph": i, "title": f"T{i}", "body": line.split("] ", 1)[1]}
                      for line in lines for i in [int(line[1:line.index("]")])]]
            return ca.Reply(json.dumps({"blocks": blocks}))
        if kind == "reduce":
            return ca.Reply("\n\n".join(b["body"] for b in json.loads(text)))
        return ca.Reply(f"{kind}({text})" if kind in ("translate", "polish") else text.replace(" uh", ""))


class Picky:
    """Fails where the prompt asks for it."""

    def generate(self, model, prompt, temperature):
        if "boom" in prompt:
            raise ValueError("no answer")
        return ca.Reply(text=prompt.upper(), in_tok=None, out_tok=None)


class Slow:
    """Takes a moment per call."""

    def generate(self, model, prompt, temperature):
        time.sleep(0.5)
        return ca.Reply(prompt[::-1])


class Silent:
    """Has no text for any prompt."""

    def generate(self, model, prompt, temperature):
        return ca.Reply(None)


class Tallying:
    """Notes every call as a file of its own in a folder; raises from the given prompt on."""

    def __init__(self, folder, last=None):
        self.folder, self.last = folder, last

    def generate(self, model, prompt, temperature):
        if self.last is not None and prompt >= self.last:
            raise SystemExit("the worker is lost")
        open(os.path.join(self.folder, uuid.uuid4().hex), "w").close()
        return ca.Reply(f"<{prompt}>")
