"""Common words of four languages: anchors of signatures, and a feature of running prose."""

COMMON_WORDS = frozenset(
    (
        "the of and to in a is that it for was on are as with be by this at from or an not but they you he she we his her which have has had were will would there their been if more when who so no out up into "
        "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein "
        "le la les de des du un une et à est en que qui dans pour il elle pas au ce sur se ne par avec plus son sa ses ou mais on nous vous ils être cette aux leur comme sont "
        "el los las una y que no por con para se lo su al del como más pero sus o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos"
    ).split()
)
