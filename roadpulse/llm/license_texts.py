"""Known licence texts and notices.

Fixed values: the texts as their authors publish them (copyright lines left out), and short notices by which works name
their licence. They stand here as plain text; digests are made from them by the operator itself.
"""

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted{kept}.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_BSD_GRANT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""

_ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

#: (licence, text). A licence may have several texts: with and without its title, and notices.
KNOWN = [
    ("MIT", _MIT_GRANT),
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC_GRANT.format(kept=", provided that the above\ncopyright notice and this permission notice appear in all copies")),
    ("ISC", "ISC License\n\n" + _ISC_GRANT.format(kept=", provided that the above\ncopyright notice and this permission notice appear in all copies")),
    ("0BSD", _ISC_GRANT.format(kept="")),
    ("BSD-2-Clause", _BSD_GRANT.format(third="")),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_GRANT.format(third="")),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", _BSD_GRANT.format(third=_BSD_THIRD)),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_GRANT.format(third=_BSD_THIRD)),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
]

#: Spellings that count as one, as plain words after punctuation went: (variant, canonical), in this order.
EQUIVALENT = [
    ("licence", "license"),
    ("licencing", "licensing"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("copyright owner", "copyright holder"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("initialise", "initialize"),
    ("merchantibility", "merchantability"),
    ("modelling", "modeling"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("per cent", "percent"),
    ("https", "http"),
]

#: Entire texts too long to stand here, as SHA-256 of their canonical form (fixed values, of the texts as published; Apache-2.0 also
#: without its appendix and without the line that ends its terms).
DIGESTS = [
    ("Apache-2.0", "ef36af97727268b60fb709836c24580bed9887f649dba6f0fd9ef4b18232fd25"),
    ("Apache-2.0", "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40"),
    ("Apache-2.0", "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GFDL-1.2", "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.3", "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GPL-1.0", "98db0b473e0a45a62b04a39b6b864b4e079a58d513e2196f94fe7252fa8574a6"),
    ("GPL-2.0", "e95eb1718f9f373d56cc586a5f7d1bfa11668867f6e85e982d2b6108b97d90a1"),
    ("GPL-3.0", "5e06bcb7b8c914d3ffb433229937b503a624ae6c7bb9ac1cad01e35a324bcb6d"),
    ("LGPL-2.0", "e4deecd0730802431ad09f00ae3793f3703c8e4dba639586545d9f958405614d"),
    ("LGPL-2.1", "d3826e4e563a04a354453ff139a32b19d6c3fe283f518eb566107c54e18cd01f"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
]
