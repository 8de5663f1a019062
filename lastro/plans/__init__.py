from lastro.plans import (
    asof,
    audits,
    boards,
    classification,
    clients,
    close,
    closes,
    contracts,
    corrections,
    digests,
    files,
    history,
    kpis,
    ledger,
    quality,
    reconcile,
    refresh,
    rulings,
    silver,
    streams,
)

SECTIONS = [
    module.section
    for module in (
        contracts,
        ledger,
        rulings,
        refresh,
        digests,
        asof,
        history,
        clients,
        close,
        closes,
        audits,
        silver,
        corrections,
        kpis,
        boards,
        reconcile,
        classification,
        quality,
        files,
        streams,
    )
]
