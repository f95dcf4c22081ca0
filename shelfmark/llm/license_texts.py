"""Wordings of public licences by label, as passages that files carry: notices and whole paragraphs.

The Creative Commons family is spelled by a rule, all others are the published wordings. Fixed values.
"""

from __future__ import annotations

_MIT = [
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions",
    "The above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
    "THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Released under the MIT License.",
]

_APACHE = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at",
    "Licensed under the Apache License, Version 2.0.",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is "
    "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
    "See the License for the specific language governing permissions and limitations under the License.",
    "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
    "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
    "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such "
    "Derivative Works in Source or Object form.",
    "apache.org/licenses/LICENSE-2.0",
]

_GPL_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)
_GPL_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as "
    "published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
    "later version."
)
_GPL_OLD_NOTICE = (
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as "
    "published by the Free Software Foundation; either version {version} of the License, or (at your option) any "
    "later version."
)


def _gnu(name: str, versions: list[str]) -> list[str]:
    """Notices of a GNU licence: with and without later versions, and the disclaimer that names it."""
    out = [_GPL_WARRANTY.format(name=name)]
    for version in versions:
        out.append(_GPL_NOTICE.format(name=name, version=version))
        out.append(_GPL_OLD_NOTICE.format(name=name, version=version))
        out.append(f"licensed under the GNU {name}, version {version}")
        out.append(f"GNU {name} version {version}")
        out.append(f"GNU {name} v{version}")
    return out


_BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE.",
]

_ISC = [
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
]

_ZLIB = [
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
    "held liable for any damages arising from the use of this software.",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
    "to alter it and redistribute it freely, subject to the following restrictions",
    "The origin of this software must not be misrepresented; you must not claim that you wrote the original "
    "software. If you use this software in a product, an acknowledgment in the product documentation would be "
    "appreciated but is not required.",
]

_BOOST = [
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
    "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
    "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
    "third-parties to whom the Software is furnished to do so, all subject to the following",
    "Distributed under the Boost Software License, Version 1.0.",
]

_MPL = [
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "Mozilla Public License Version 2.0",
]

_UNLICENSE = [
    "This is free and unencumbered software released into the public domain.",
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
    "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all "
    "copyright interest in the software to the public domain. We make this dedication for the benefit of the public "
    "at large and to the detriment of our heirs and successors.",
]

_CC_NAMES = {"by": ["Attribution"], "nc": ["NonCommercial", "Non-Commercial"],
             "nd": ["NoDerivatives", "NoDerivs", "No Derivatives"], "sa": ["ShareAlike", "Share Alike"]}
_CC_MEMBERS = ["by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"]
_CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}


def _creative_commons(member: str) -> list[str]:
    """Names, short names and addresses of one member; no member's passages stand in another's."""
    names = [""]
    for part in member.split("-"):
        names = [f"{n}-{spelled}" if n else spelled for n in names for spelled in _CC_NAMES[part]]
    out = [f"Creative Commons {name} {version}" for name in names for version in _CC_VERSIONS]
    out += [f"Creative Commons {name} {kind} License" for name in names for kind in {"": 0, **dict.fromkeys(_CC_VERSIONS.values())}]
    out += [f"CC {member} {version}" for version in _CC_VERSIONS]
    return out + [f"creativecommons.org/licenses/{member}/{version}" for version in _CC_VERSIONS]


_CC0 = [
    "Creative Commons Zero",
    "Creative Commons CC0",
    "CC0 1.0",
    "creativecommons.org/publicdomain/zero/1.0",
    "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of "
    "his or her rights to the work worldwide under copyright law, including all related and neighboring rights, to "
    "the extent allowed by law.",
]

# label -> passages
TEMPLATES = {
    "mit": _MIT,
    "apache": _APACHE,
    "gpl": _gnu("General Public License", ["2", "3"]),
    "lgpl": _gnu("Lesser General Public License", ["2.1", "3"]),
    "agpl": _gnu("Affero General Public License", ["3"]),
    "bsd": _BSD,
    "isc": _ISC,
    "zlib": _ZLIB,
    "boost": _BOOST,
    "mpl": _MPL,
    "unlicense": _UNLICENSE,
    **{f"cc-{member}": _creative_commons(member) for member in _CC_MEMBERS},
    "cc0": _CC0,
}
