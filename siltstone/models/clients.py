"""Text generation behind one interface.

A client maps prompts to replies. ``generate`` runs it in Arrow batches, one client a task, and writes the replies to
a table before they fan out, because a model asked again may answer differently. ``Template`` is a deterministic client
for tests and for runs without a model, ``Replay`` looks replies up, ``Http`` calls a served model.
"""

from __future__ import annotations

import json
import re
import time
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.arrow import map_rows
from siltstone.functions.parse import TRIPLET_END, TRIPLET_START
from siltstone.io import cut


@dataclass
class Template:
    """Three triplets from the first sentences of the passage behind the last ``Text:`` of a prompt.

    As a judge it finds short answers doubtful and says nothing that can be parsed about answers with a colon.
    """

    triplets: int = 3

    def __call__(self, prompts: list[str]) -> list[str]:
        return [self.reply(p) for p in prompts]

    def reply(self, prompt: str) -> str:
        kind, _, body = prompt.rpartition("Text:")
        body = body.strip()
        if kind.startswith("RATE"):
            words = re.findall(r"\w+", body)
            return f"{min(1.0, 0.4 + len(set(words)) / 100):.2f}"
        if kind.startswith("JUDGE"):
            answer = kind.partition("Answer:")[2].partition("Instruction:")[0]
            if ":" in answer:
                return "This one is hard to tell."
            good = len(answer.split()) >= 9
            return json.dumps({"valid": good, "scores": {"answer_validity": 0.9 if good else 0.4, "question_quality": 0.8, "instruction_quality": 0.8}, "issues": [], "improvements": []})
        sentences = [s for s in re.split(r"(?<=[.!?])\s+", body) if len(s.split()) >= 5][: self.triplets]
        parts = [f"{TRIPLET_START}\nQUESTION: Which facts does the given passage state in its sentence number {i + 1}?\nANSWER: {' '.join(s.split())}\nINSTRUCTION: Find sentence {i + 1} and repeat what it says.\n{TRIPLET_END}" for i, s in enumerate(sentences)]
        return "\n".join(parts)


@dataclass
class Asker:
    """A deterministic stand-in that asks one question about an answer, and shortens long questions when it revises them."""

    def __call__(self, prompts: list[str]) -> list[str]:
        return [self.reply(p) for p in prompts]

    def reply(self, prompt: str) -> str:
        answer = prompt.partition(": ")[2].partition("\n")[0]
        if prompt.startswith("ASK"):
            return f"Question Type: direct\nQuestion: Of what does the text say {answer.rstrip('.')}?\nVerification: it stands there\nComplexity: 0.3"
        long = [q for q in prompt.split("\n")[1:-1] if len(q.split()) > 20]
        return "\n\n".join(f"Original: {q}\nImproved: {' '.join(q.split()[:20]).rstrip('?')}?\nReasoning: shorter\nKeep/Replace: Replace" for q in long)


@dataclass
class Replay:
    """Replies by prompt; unknown prompts give an empty reply."""

    replies: dict[str, str] = field(default_factory=dict)

    def __call__(self, prompts: list[str]) -> list[str]:
        return [self.replies.get(p, "") for p in prompts]


@dataclass
class Http:
    """A served model that takes {"prompt": …, "max_tokens": …} and returns {"text": …}; tries again with pauses."""

    url: str
    max_tokens: int = 1024
    tries: int = 3
    timeout: float = 120.0

    def __call__(self, prompts: list[str]) -> list[str]:
        return [self.ask(p) for p in prompts]

    def ask(self, prompt: str) -> str:
        for k in range(self.tries):
            try:
                request = urllib.request.Request(self.url, json.dumps({"prompt": prompt, "max_tokens": self.max_tokens}).encode(), {"Content-Type": "application/json"})
                with urllib.request.urlopen(request, timeout=self.timeout) as r:
                    return json.load(r).get("text", "")
            except (OSError, ValueError):
                time.sleep(2**k)
        return ""


@dataclass
class Fallback:
    """Asks the next client where one fails or replies with nothing."""

    clients: tuple = ()

    def __call__(self, prompts: list[str]) -> list[str]:
        replies = [""] * len(prompts)
        for c in self.clients:
            open_ = [i for i, r in enumerate(replies) if not r]
            if not open_:
                break
            try:
                for i, r in zip(open_, c([prompts[i] for i in open_])):
                    replies[i] = r
            except Exception:  # noqa: BLE001 - the next client is asked
                continue
        return replies


@dataclass
class Retry:
    """Asks again, with pauses, where a reply does not pass ``ok``; the last reply stays if none does."""

    model: Callable
    ok: Callable[[str], bool]
    tries: int = 3
    pause: float = 1.0

    def __call__(self, prompts: list[str]) -> list[str]:
        replies = each(self.model, prompts)
        for _ in range(self.tries - 1):
            open_ = [i for i, r in enumerate(replies) if not self.ok(r)]
            if not open_:
                break
            time.sleep(self.pause)
            for i, r in zip(open_, each(self.model, [prompts[i] for i in open_])):
                replies[i] = r
        return replies


def verdict_ok(reply: str) -> bool:
    """Whether a reply holds a verdict as ``parse_verdicts`` wants it."""
    try:
        v = json.loads(reply[reply.index("{") : reply.rindex("}") + 1])
        numbers = list(v["scores"].values())
        named = all(n in v["scores"] for n in ("answer_validity", "question_quality", "instruction_quality"))
        return isinstance(v["valid"], bool) and isinstance(v["issues"], list) and isinstance(v["improvements"], list) and named and all(isinstance(x, int | float) and not isinstance(x, bool) and 0 <= x <= 1 for x in numbers)
    except (ValueError, KeyError, TypeError, AttributeError):
        return False


@dataclass
class Local:
    """A model in the worker's own process: ``load`` gives a function from prompts to replies, once a process."""

    name: str
    load: Callable[[], Callable[[list[str]], list[str]]]

    def __call__(self, prompts: list[str]) -> list[str]:
        return shared(self.name, self.load)(prompts)


_SHARED: dict[str, object] = {}


def shared(name: str, load: Callable[[], object]):
    """One instance a process: the first caller of a name loads it; workers are used again from task to task."""
    if name not in _SHARED:
        _SHARED[name] = load()
    return _SHARED[name]


def forget_shared() -> None:
    _SHARED.clear()


CLIENTS: dict[str, Callable] = {"template": Template, "replay": Replay, "http": Http, "fallback": Fallback}
#: Clients by the type of a model's configuration; what runs in the process is given as a loader under its name.
LOADERS: dict[str, Callable[[dict], Callable]] = {}


def client(name: str, **options):
    """A client by name; unknown names raise."""
    if name not in CLIENTS:
        raise ValueError(f"no client {name}; there are {sorted(CLIENTS)}")
    return CLIENTS[name](**options)


def client_of(config: dict, name: str | None = None):
    """The client of a configured model (``models`` section): ``api`` and ``vllm`` are served, ``transformers`` run in the process.

    ``name`` defaults to ``default_model``. Unknown models and types raise ``ValueError``.
    """
    models = config.get("llm_models") or {}
    name = name or config.get("default_model")
    if name not in models:
        raise ValueError(f"no model {name}; there are {sorted(models)}")
    model = models[name]
    kind, parameters = model.get("type"), model.get("parameters") or {}
    if kind in ("api", "vllm"):
        url = model.get("url") or (config.get("serving") or {}).get(kind, {}).get("url")
        if not url:
            raise ValueError(f"model {name} has no url")
        return Http(url, **{k: parameters[k] for k in ("max_tokens", "tries", "timeout") if k in parameters})
    if kind == "transformers":
        if model["name"] not in LOADERS:
            raise ValueError(f"no loader for {model['name']}; add one to LOADERS")
        return Local(model["name"], lambda: LOADERS[model["name"]](parameters))
    raise ValueError(f"model {name} has the unknown type {kind}")


def model_info(config: dict, name: str) -> dict:
    """What is configured about a model, with its estimated memory in GB."""
    model = (config.get("llm_models") or {})[name]
    return {"name": model.get("name"), "type": model.get("type"), "parameters": model.get("parameters") or {}, "memory_gb": memory_gb(model.get("name", ""), (model.get("parameters") or {}).get("dtype", "float16"))}


def memory_gb(name: str, dtype: str = "float16") -> float | None:
    """Memory of a model by the billions of parameters in its name (``…-8b``), a fifth added; null without such a part."""
    m = re.search(r"(\d+(?:\.\d+)?)b(?![a-z])", name.lower())
    return round(float(m[1]) * {"float32": 4, "int8": 1, "int4": 0.5}.get(dtype, 2) * 1.2, 1) if m else None


def gpu_profile(gpus: int = 1, tasks_per_gpu: int = 1, discovery: str | None = None):
    """A resource profile for stages that ask a model on GPUs; Spark places their tasks."""
    from pyspark.resource import ExecutorResourceRequests, ResourceProfileBuilder, TaskResourceRequests

    executor = ExecutorResourceRequests().resource("gpu", gpus, discovery or "")
    return ResourceProfileBuilder().require(executor).require(TaskResourceRequests().resource("gpu", 1 / tasks_per_gpu)).build


def each(model: Callable[[list[str]], list[str]], prompts: list[str]) -> list[str]:
    """Replies to all prompts at once; if that fails, one by one, and those that fail alone are empty."""
    try:
        replies = list(model(prompts))
        if len(replies) == len(prompts):
            return ["" if r is None else r for r in replies]
    except Exception:  # noqa: BLE001 - a model's failure must not end the run
        pass
    if len(prompts) == 1:
        return [""]
    return [r for p in prompts for r in each(model, [p])]


def generate(prompts: DataFrame, model: Callable[[list[str]], list[str]], key: list[str], prompt: str = "prompt", spread: int | None = None, profile=None) -> DataFrame:
    """``key, prompt, reply`` as a table. A failing prompt gives an empty reply, the others of its batch are kept.

    ``spread``: ask in so many tasks, where a model is slow against the shuffle of the prompts. ``profile``: resources of
    these tasks (``gpu_profile``).
    """
    kinds = dict(prompts.dtypes)
    columns = ", ".join(f"{k} {kinds[k]}" for k in key)

    def make():
        def f(*columns):
            return *columns, each(model, list(columns[-1]))

        return f

    asked = prompts.select(*key, prompt)
    if spread:
        asked = asked.repartition(spread, *key)
    return cut(map_rows(asked, make, f"{columns}, prompt string, reply string", profile), "replies")


def usage_of(replies: DataFrame, model: str, task: str) -> DataFrame:
    """Usage rows by the estimate of four characters a token."""
    return replies.select(F.lit(model).alias("model"), F.lit(task).alias("task"), F.current_timestamp().alias("ts"), F.lit(0.0).alias("duration"), F.floor(F.length("prompt") / 4).alias("input_tokens"), F.floor(F.length("reply") / 4).alias("output_tokens"), (F.col("reply") != "").alias("success"), F.lit(None).cast("string").alias("error"))
