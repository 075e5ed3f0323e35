"""Settings of a run: plain values, given by the caller or read from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

#: Names of OCR back ends.
OCR_BACKENDS = ("external", "hosted", "local")


@dataclass(frozen=True)
class Settings:
    """``use_llm=False`` means that no model is called at all, for extraction or for second opinions."""

    llm_api_key: str | None = None
    llm_base_url: str | None = None
    llm_model: str | None = None
    llm_temperature: float = 0.1
    use_llm: bool = True
    ocr_backend: str = "external"
    ocr_model_path: str | None = None
    ocr_max_dimension: int = 1024
    ocr_device: str = "auto"
    ocr_api_key: str | None = None
    ocr_base_url: str | None = None
    ocr_model: str | None = None
    pdf_dpi: int = 300

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, prefix: str = "") -> Settings:
        """Settings from variables named as the fields in upper case; texts are read as the field's type."""
        env = dict(os.environ) if env is None else env
        found = {}
        for f in fields(cls):
            raw = env.get(prefix + f.name.upper())
            if raw is not None:
                found[f.name] = raw.lower() in ("1", "true", "yes") if f.type == "bool" else int(raw) if f.type == "int" else float(raw) if f.type == "float" else raw
        return cls(**found)

    def for_ocr(self) -> tuple[str | None, str | None, str | None]:
        """Key, address and model of hosted OCR; what isn't set falls back to the language model's."""
        return self.ocr_api_key or self.llm_api_key, self.ocr_base_url or self.llm_base_url, self.ocr_model or self.llm_model

    def calls_model(self) -> bool:
        return self.use_llm and bool(self.llm_api_key)
