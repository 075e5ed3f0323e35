"""Back ends for ``tamarack.backends``: PDF pages, hosted and local page reading, and a chat model.

Each is made from :class:`Settings`; what it needs beyond the standard library is imported when it is made, on the
worker, so nothing here is needed to extract from texts.  The hosted ones speak the common chat-completions protocol.
"""

from __future__ import annotations

import base64
import importlib.util
import io
import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable

from tamarack import backends
from tamarack.config import Settings
from tamarack.operators.reclassify import VALID

#: Tokens of a page and of a second opinion, tries of a second opinion, seconds between tries.
HOSTED_TOKENS, LOCAL_TOKENS, SECOND_TOKENS, SECOND_TRIES, PAUSE, LONG_PAUSE = 8192, 10_000, 300, 3, 1.0, 10.0

PAGE_PROMPT = (
    "Write out all text on this page, in reading order and as it stands. Give each table as HTML. Put signatures in "
    "<signature></signature>, watermarks in <watermark></watermark> and page numbers in <page_number></page_number>. "
    "Where handwriting is unclear, add [?]. Return the text of the page and nothing else."
)
MODEL_ROLE = (
    "You read court agreements and answer with one JSON object. You keep apart what a party must do in any case, what it "
    "must do only after a breach, and what merely records that a notice was served."
)
MODEL_PROMPT = """\
From the eviction agreement below, fill in this JSON object; use null for what the text does not say.

case_number, plaintiff (the landlord), defendant (the tenant), agreement_signed_date,
payment_schedule: a list, one item for each payment, with
  due_date (YYYY-MM-DD), payment_type ("fixed_amount" or "monthly_rent"), amount (digits only), month_rent, time, extra_text,
mandatory_vacate_date (YYYY-MM-DD), outcome_type, outcome_details, additional_agreement_terms (joined by "; "),
sealing_reference_stipulation, enforcement_period, assistance_deadline.

How to decide:
- A line such as "March rent" is a monthly_rent item with month_rent "March"; it has an amount only if the text states one.
- Tables may have several columns; a date or sum can stand in any of them.
- mandatory_vacate_date is set only for a duty to leave that does not depend on a breach. Receipt of a notice to vacate is
  no such duty, nor is leaving after a default.
- outcome_type is "Pay and Stay" with payments and no such duty, "Pay and Vacate" with both, "Vacate Only" with the duty alone.

Agreement:
"""
SECOND_ROLE = (
    "You settle how an eviction agreement ends. Answer with one JSON object: outcome_type, one of "
    + ", ".join(f'"{a}"' for a in VALID)
    + "; confidence, from 0 to 1; reasoning, one sentence. A duty to leave that only follows a breach does not count as leaving."
)


class ChatClient:
    """A chat-completions endpoint."""

    def __init__(self, key: str | None, url: str | None, model: str | None, timeout: float = 300.0) -> None:
        if not (key and url and model):
            raise ValueError("a hosted model needs a key, an address and a name")
        self.key, self.url, self.model, self.timeout = key, url.rstrip("/") + "/chat/completions", model, timeout

    def ask(self, messages: list[dict], **more) -> str:
        body = json.dumps({"model": self.model, "messages": messages} | more).encode()
        request = urllib.request.Request(self.url, body, {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return json.load(answer)["choices"][0]["message"]["content"] or ""
        except urllib.error.HTTPError as e:
            raise RuntimeError(f"{e.code} {e.read().decode(errors='replace')[:300]}") from e


class PdfPages:
    """Pages of a PDF by ``pdf2image`` (and poppler)."""

    def __init__(self) -> None:
        from pdf2image import convert_from_bytes

        self.convert = convert_from_bytes

    def pages(self, pdf: bytes, dpi: int) -> list[bytes]:
        out = []
        for image in self.convert(pdf, dpi=dpi):
            held = io.BytesIO()
            image.convert("RGB").save(held, "PNG")
            out.append(held.getvalue())
        return out


class HostedReader:
    """The text on a page, by a hosted model that takes images."""

    def __init__(self, settings: Settings, prompt: str = PAGE_PROMPT) -> None:
        self.client, self.prompt = ChatClient(*settings.for_ocr()), prompt

    def read(self, png: bytes) -> str:
        image = {"type": "image_url", "image_url": {"url": "data:image/png;base64," + base64.b64encode(png).decode()}}
        message = {"role": "user", "content": [image, {"type": "text", "text": self.prompt}]}
        return self.client.ask([message], max_tokens=HOSTED_TOKENS, temperature=1.0)


class LocalReader:
    """The text on a page, by a vision-language model from a folder, loaded once in a worker."""

    def __init__(self, settings: Settings, prompt: str = PAGE_PROMPT) -> None:
        import torch
        from PIL import Image
        from transformers import AutoModelForVision2Seq, AutoProcessor

        if not settings.ocr_model_path:
            raise ValueError("local reading needs ocr_model_path")
        self.torch, self.image, self.prompt, self.most = torch, Image, prompt, settings.ocr_max_dimension
        self.device = settings.ocr_device if settings.ocr_device != "auto" else "cuda" if torch.cuda.is_available() else "cpu"
        kind = torch.float16 if self.device != "cpu" else torch.float32
        self.model = AutoModelForVision2Seq.from_pretrained(settings.ocr_model_path, torch_dtype=kind).to(self.device).eval()
        self.processor = AutoProcessor.from_pretrained(settings.ocr_model_path)

    def read(self, png: bytes) -> str:
        page = self.image.open(io.BytesIO(png)).convert("RGB")
        page.thumbnail((self.most, self.most))
        message = {"role": "user", "content": [{"type": "image", "image": page}, {"type": "text", "text": self.prompt}]}
        told = self.processor.apply_chat_template([message], tokenize=False, add_generation_prompt=True)
        given = self.processor(text=[told], images=[page], padding=True, return_tensors="pt").to(self.device)
        with self.torch.no_grad():
            ids = self.model.generate(**given, max_new_tokens=LOCAL_TOKENS, do_sample=False)
        return self.processor.batch_decode(ids[:, given.input_ids.shape[1] :], skip_special_tokens=True)[0]


class ChatModel:
    """The extraction of a text, as JSON."""

    def __init__(self, settings: Settings) -> None:
        self.client = ChatClient(settings.llm_api_key, settings.llm_base_url, settings.llm_model)
        self.temperature = settings.llm_temperature

    def answer(self, text: str) -> str:
        messages = [{"role": "system", "content": MODEL_ROLE}, {"role": "user", "content": MODEL_PROMPT + text}]
        return self.client.ask(messages, temperature=self.temperature, response_format={"type": "json_object"})


class SecondOpinion:
    """How an agreement ends, as JSON.  An answer that names no outcome is asked for again after a second, and a
    refused call after 10, 20 ... seconds."""

    def __init__(self, settings: Settings, wait: Callable[[float], None] = time.sleep) -> None:
        self.client, self.wait = ChatClient(settings.llm_api_key, settings.llm_base_url, settings.llm_model), wait

    def answer(self, text: str) -> str:
        messages = [{"role": "system", "content": SECOND_ROLE}, {"role": "user", "content": text}]
        for k in range(SECOND_TRIES):
            try:
                told = self.client.ask(messages, temperature=0, max_tokens=SECOND_TOKENS)
                plain = re.sub(r"\A\s*```(?:json)?\s*|\s*```\s*\Z", "", told)
                if json.loads(plain).get("outcome_type") in VALID:
                    return plain
                pause = PAUSE
            except (ValueError, AttributeError):
                pause = PAUSE
            except RuntimeError as e:
                if "429" not in str(e) and "rate_limit" not in str(e).lower():
                    raise
                pause = LONG_PAUSE * (k + 1)
            self.wait(pause)
        raise ValueError("no answer named an outcome")


def reader(settings: Settings) -> Callable[[], backends.PageReader]:
    """A factory for the page reader that the settings name."""
    kinds = {"hosted": HostedReader, "local": LocalReader}
    if settings.ocr_backend not in kinds:
        raise ValueError(f"the OCR back end {settings.ocr_backend!r} can't read PDFs; use one of {', '.join(kinds)}")
    return lambda: kinds[settings.ocr_backend](settings)


def can_rasterize() -> bool:
    return importlib.util.find_spec("pdf2image") is not None
