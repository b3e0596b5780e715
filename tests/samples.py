"""Synthetic tables and parameters shared by several test modules."""

from __future__ import annotations

import numpy as np
import pandas as pd

from oddrow.profiles import NSL_KDD

CATEGORIES = {
    "protocol_type": ["tcp", "udp", "icmp"],
    "service": ["http", "ftp", "smtp", "ssh", "dns", "ftp_data", "other"],
    "flag": ["SF", "S0", "REJ", "RSTO", "RSTOS0", "SH", "OTH"],
}


def connections(
    n_normal: int, n_attack: int, seed: int = 42, shift: float = 0.0
) -> pd.DataFrame:
    """Connection records: normal rows, then attacks whose numbers are shifted."""
    rng = np.random.default_rng(seed)
    n = n_normal + n_attack
    values = rng.normal(size=(n, len(NSL_KDD.numeric)))
    values[n_normal:] += shift
    table = pd.DataFrame(values, columns=list(NSL_KDD.numeric))
    for name, options in CATEGORIES.items():
        table[name] = rng.choice(options, n)
    table["label"] = ["normal"] * n_normal + ["neptune"] * n_attack
    return table


def job(path: str, artefact_dir: str, **training) -> dict:
    """Parameters of a small training job."""
    return {
        "dataset": {"path": path, "schema": "nsl_kdd"},
        "splits": {"train_ratio": 0.7, "val_ratio": 0.1, "test_ratio": 0.2, "random_seed": 42},
        "architecture": {
            "encoder_layers": [32, 16], "bottleneck_dim": 8, "activation": "relu",
            "dropout_rate": 0.2,
        },
        "training": {
            "learning_rate": 0.001, "batch_size": 32, "max_epochs": 3, "patience": 3,
            "lr_schedule": "none", "random_seed": 0,
        } | training,
        "threshold": {"percentile": 95},
        "output": {"artefact_dir": artefact_dir},
    }
