"""Connected components, as all operators have them."""

from __future__ import annotations

from sugarloom.operators.components import connected_components  # noqa: F401
