"""Settings of the four programs: sections of a YAML or JSON file as dataclasses, with a default for every field."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any

from ..functions.text import BACKOFF_BASE, BACKOFF_FACTOR

# The names and defaults of all settings. Names that end in _dir or _file are paths.


@dataclass(slots=True)
class Logging:
    level: str = "INFO"
    log_file: str | None = None


@dataclass(slots=True)
class DownloadOutput:
    videos_dir: str = "data/raw/videos"
    audio_dir: str = "data/raw/audio"
    metadata_dir: str = "data/raw/metadata"
    history_file: str = "data/raw/download_history.csv"


@dataclass(slots=True)
class Download:
    quality: str = "1080"
    format: str = "mp4"
    audio_only: bool = False
    rate_limit: str | None = None
    concurrent_fragments: int = 4


@dataclass(slots=True)
class Retry:
    max_retries: int = 3
    retry_delay_seconds: float = BACKOFF_BASE
    backoff_factor: float = BACKOFF_FACTOR


@dataclass(slots=True)
class Network:
    socket_timeout: int = 30
    cookies_file: str | None = None


@dataclass(slots=True)
class Playlist:
    max_items: int | None = None


@dataclass(slots=True)
class Acquisition:
    output: DownloadOutput = field(default_factory=DownloadOutput)
    download: Download = field(default_factory=Download)
    retry: Retry = field(default_factory=Retry)
    network: Network = field(default_factory=Network)
    playlist: Playlist = field(default_factory=Playlist)
    logging: Logging = field(default_factory=Logging)


@dataclass(slots=True)
class VideoInput:
    videos_dir: str = "data/raw/videos"


@dataclass(slots=True)
class AudioOutput:
    audio_dir: str = "data/raw/audio"
    history_file: str = "data/raw/audio_extract_history.csv"


@dataclass(slots=True)
class Extract:
    format: str = "wav"
    sample_rate: int = 16_000
    channels: int = 1


@dataclass(slots=True)
class Audio:
    input: VideoInput = field(default_factory=VideoInput)
    output: AudioOutput = field(default_factory=AudioOutput)
    extract: Extract = field(default_factory=Extract)
    logging: Logging = field(default_factory=Logging)


@dataclass(slots=True)
class AudioInput:
    audio_dir: str = "data/raw/audio"


@dataclass(slots=True)
class TranscriptOutput:
    transcripts_dir: str = "data/transcripts"
    history_file: str = "data/transcripts/transcription_history.csv"


@dataclass(slots=True)
class SpeechModel:
    size: str = "large-v3"
    device: str = "auto"
    compute_type: str = "default"
    language: str | None = "en"
    vad_filter: bool = True
    word_timestamps: bool = True
    beam_size: int = 5


@dataclass(slots=True)
class Transcription:
    input: AudioInput = field(default_factory=AudioInput)
    output: TranscriptOutput = field(default_factory=TranscriptOutput)
    model: SpeechModel = field(default_factory=SpeechModel)
    logging: Logging = field(default_factory=Logging)


@dataclass(slots=True)
class DiarizationInput:
    audio_dir: str = "data/raw/audio"
    transcripts_dir: str = "data/transcripts"


@dataclass(slots=True)
class DiarizationOutput:
    diarized_dir: str = "data/diarized"
    history_file: str = "data/diarized/diarization_history.csv"


@dataclass(slots=True)
class SpeakerModel:
    pipeline: str = "pyannote/speaker-diarization-3.1"
    device: str = "auto"


@dataclass(slots=True)
class Speaker:
    strategy: str = "longest_total_duration"


@dataclass(slots=True)
class Diarization:
    input: DiarizationInput = field(default_factory=DiarizationInput)
    output: DiarizationOutput = field(default_factory=DiarizationOutput)
    model: SpeakerModel = field(default_factory=SpeakerModel)
    target_speaker: Speaker = field(default_factory=Speaker)
    logging: Logging = field(default_factory=Logging)


PROGRAMS = {"acquisition": Acquisition, "audio": Audio, "transcription": Transcription, "diarization": Diarization}


def _absolute(path: str, root: Path) -> str:
    return path if "://" in path or Path(path).is_absolute() else str(root / path)


def _value(name: str, default: Any, given: Any, root: Path) -> Any:
    if name == "language":  # as text.language() has it
        given = None if given is None or str(given).strip().lower() in ("", "auto") else str(given).strip()
    if name.endswith(("_dir", "_file")):
        return None if given is None else _absolute(str(given), root)
    return given if given is None or default is None else type(default)(given)


def filled(kind: type, given: dict[str, Any] | None, root: Path):
    """A dataclass from a mapping: fields that aren't given keep their defaults, unknown names are ignored, values take the
    type of the default, paths stand under root.
    """
    given, values = given or {}, {}
    for f in fields(kind):
        if f.default_factory is not f.default and is_dataclass(f.default_factory):
            values[f.name] = filled(f.default_factory, given.get(f.name), root)
        else:
            values[f.name] = _value(f.name, f.default, given.get(f.name, f.default), root)
    return kind(**values)


def load(program: str, path: str | Path, root: str | Path | None = None):
    """The settings of a program from a YAML or JSON file; FileNotFoundError if there is none, KeyError for another program.

    Relative paths stand under the project: root, or the folder that holds the folder of the settings.
    """
    kind, at = PROGRAMS[program], Path(path)
    if not at.exists():
        raise FileNotFoundError(at)
    text = at.read_text(encoding="utf-8")
    try:
        import yaml

        given = yaml.safe_load(text)
    except ImportError:
        given = json.loads(text or "{}")
    return filled(kind, given, Path(root) if root else at.resolve().parent.parent)
