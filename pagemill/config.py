"""Settings as frozen dataclasses, and key=value command lines that override them."""

from __future__ import annotations

import dataclasses
import typing


@dataclasses.dataclass(frozen=True)
class PageConfig:
    """A synthetic page: sizes in points at 72 dots per inch, chunks in characters."""

    dataset_path: str = "corpus"
    data_directory: str = ""
    split: str = "train"
    key_column: str = "doc_id"
    output_path: str = "pages"
    show_sample: bool = False
    font_dirs: str = "/usr/share/fonts,/usr/local/share/fonts"
    max_text_length: int = 2000
    max_entries: int = 400
    num_examples: int = 0
    text_column: str = "text"
    image_width: int = 512
    image_height: int = 512
    image_dpi: int = 72
    font_size: int = 12
    font_path: str = "default"
    font_color: str = "black"
    bg_color: str = "white"
    vertical_alignment: str = "center"
    horizontal_alignment: str = "left"
    max_width_ratio: float = 0.9
    tab_width: int = 4
    random_fonts: bool = True
    random_backgrounds: bool = True
    random_font_color: bool = True
    seed: int = 42


@dataclasses.dataclass(frozen=True)
class PackConfig:
    """Packed token blocks for language-model training. Without a tokenizer's file, tokens are code points."""

    dataset_path: str = "corpus"
    data_directory: str = ""
    key_column: str = "doc_id"
    text_column: str = "document"
    tokenizer: str = ""
    output_path: str = "blocks"
    max_length: int = 512
    max_train: int = 0
    max_eval: int = 10
    batch_size: int = 8
    accumulation: int = 4
    epochs: int = 1
    seed: int = 42


@dataclasses.dataclass(frozen=True)
class GoldConfig:
    """Pairs of scans and transcriptions."""

    image_dir: str = "images"
    text_dir: str = "text"
    output_dir: str = "out"


def _parsed(kind: type, text: str):
    if kind is bool:
        if text.lower() not in ("true", "false", "1", "0"):
            raise TypeError(f"not a truth value: {text}")
        return text.lower() in ("true", "1")
    try:
        return kind(text)
    except ValueError as e:
        raise TypeError(str(e)) from e


def from_arguments(kind: type, arguments: list[str]):
    """kind(**overrides) from key=value words; an unknown key or a value of the wrong type raises TypeError."""
    types = typing.get_type_hints(kind)
    found = {}
    for a in arguments:
        key, eq, value = a.partition("=")
        if not eq or key not in types:
            raise TypeError(f"unknown setting: {a}")
        found[key] = _parsed(types[key], value)
    return kind(**found)
