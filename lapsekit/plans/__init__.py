"""Composition of operators into the model's layers and the full build."""

from lapsekit.plans.layers import Layers

__all__ = ["Layers"]
