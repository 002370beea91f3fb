"""DataFrame operators shared by the builders."""

from voltmark.operators.conform import conform, typed
from voltmark.operators.dedup import latest_per_key
from voltmark.operators.intake import Intake
from voltmark.operators.ranking import top_k
from voltmark.operators.reconcile import differing

__all__ = ["Intake", "conform", "differing", "latest_per_key", "top_k", "typed"]
