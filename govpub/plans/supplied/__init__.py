"""The operators run on the supplied tables, each beside the SQL that states its result."""

from govpub.plans.supplied import checks, derivations, gold, governance, serving  # noqa: F401  (register their queries)
from govpub.plans.supplied.base import ORACLES, QUERIES  # noqa: F401
